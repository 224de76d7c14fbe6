"""Quality and toxicity: held-out accuracy, and defined results without anything to learn from."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from oreworks.llm import quality_gam, toxicity

from .conftest import documents

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def held_out_accuracy(rows, truth, fold, mod):
    hits = [r.predicted == truth[r.doc_id] for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == fold) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    return np.mean(hits)


def test_quality_on_held_out_documents(spark, labels):
    rows = quality_gam.quality_scores(documents(spark, SF), labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == 1000 and held_out_accuracy(rows, truth, 0, 5) >= 0.93


def test_toxicity_on_held_out_documents(spark, labels):
    rows = toxicity.toxicity_scores(documents(spark, SF), labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(rows) == 1000 and held_out_accuracy(rows, truth, 2, 4) >= 0.87


def test_held_out_labels_are_not_learned(spark, labels):
    """Scores stay the same when the labels of the held-out fold are turned round."""
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    docs = documents(spark, SF).where("doc_id < 100")
    scores = [{r.doc_id: r.score for r in quality_gam.quality_scores(docs, y).collect()} for y in (labels, turned)]
    assert scores[0] == scores[1]


@pytest.mark.parametrize(("operator", "score", "label"), [(quality_gam, "quality_scores", "quality"), (toxicity, "toxicity_scores", "toxic")])
def test_awkward_rows(spark, awkward, no_docs, monkeypatch, operator, score, label):
    monkeypatch.setattr(toxicity, "READINGS", 200)
    run = getattr(operator, score)
    some = spark.createDataFrame(
        [(i, v, "x") for i, v in [(1, 1), (1, 0), (3, 0), (5, 1), (6, 0), (7, 1), (8, None), (99, 1), (None, 1), (-9, 0)]],
        f"doc_id long, {label} int, text string",
    )
    none = some.where("false")
    for y in (some, none, some.where(f"{label} = 1")):
        rows = run(awkward, y).collect()
        assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
        blank = {round(r.score, 9) for r in rows if r.doc_id in (2, 3) or r.doc_id is None and False}
        assert len(blank) == 1
        assert run(no_docs, y).count() == 0
    keep = quality_gam.keep_good if operator is quality_gam else toxicity.keep_clean
    kept = keep(awkward, none)
    assert kept.columns == awkward.columns and kept.count() == 12


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        ids = np.arange(1, n + 1)
        w = toxicity.windows(ids)
        assert w.shape[1] == toxicity.WINDOW and set(w.ravel()) - {0} == set(ids.tolist())
        for a, b in zip(w, w[1:], strict=False):
            assert (a[toxicity.STRIDE :] == b[: toxicity.STRIDE]).all()


def test_gradients_against_differences():
    """Backpropagation through both directions and the attention, against numeric differences."""
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh({"a": 1, "b": 2}, 0.3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    ids = np.array([[1, 2], [2, 1], [2, 0], [1, 0]])
    y = np.array([1.0, 0.0])
    inputs = np.concatenate([np.zeros((1, 2 * toxicity.WIDTH)), rng.standard_normal((2, 2 * toxicity.WIDTH))])

    def loss():
        x = inputs[ids]
        odds = net.window_odds(x @ net.p["Wf"] + net.p["cf"], x @ net.p["Wb"] + net.p["cb"], ids > 0)
        return np.mean(np.log1p(np.exp(odds)) - y * odds)

    seen = {}
    trainer = toxicity._Trainer(net)
    trainer._adam = lambda k, at, grad: seen.setdefault(k, grad)
    trainer.learn(ids, y, np.array([0, 1, 2]), [np.empty(0, int), np.array([3]), np.array([4])], inputs)
    for name in ("Wf", "Ub", "cf", "cb", "v", "u", "b"):
        for at in list(np.ndindex(net.p[name].shape))[:: max(1, net.p[name].size // 5)]:
            keep, step = net.p[name][at], 1e-3
            net.p[name][at] = keep + step
            up = loss()
            net.p[name][at] = keep - step
            down = loss()
            net.p[name][at] = keep
            assert seen[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-3), name


def test_scoring_does_not_depend_on_batches_or_memory(monkeypatch):
    monkeypatch.setattr(toxicity, "READINGS", 1000)
    net = toxicity.fit([["good day to all"], ["you idiot person"]] * 20, np.array([0, 1] * 20, dtype=np.float32))
    texts = ["good " * 100, None, "an idiot " * 3, "", "unseen words only", "day " * 5000]
    whole = net.scores(texts)
    one = np.concatenate([toxicity.Network(net.words, net.p).scores([t]) for t in texts])
    monkeypatch.setattr(toxicity, "REMEMBERED_WORDS", 2)
    again = toxicity.Network(net.words, net.p).scores(texts)
    assert np.allclose(whole, one, atol=1e-5) and np.allclose(whole, again, atol=1e-5)


def test_inputs_of_many_new_words_are_made_in_parts(monkeypatch):
    monkeypatch.setattr(toxicity, "READINGS", 1000)
    net = toxicity.fit([["good day to all"], ["you idiot person"]] * 20, np.array([0, 1] * 20, dtype=np.float32))
    texts = [" ".join(f"{a}{b}x" for b in "abcdefgh") for a in "klmnopq"] + [None]
    whole, sizes = toxicity.Network(net.words, net.p).scores(texts), []
    monkeypatch.setattr(toxicity, "NEW_WORDS", 5)
    inputs_of = toxicity.Network.inputs_of
    monkeypatch.setattr(toxicity.Network, "inputs_of", lambda self, words: (sizes.append(len(words)), inputs_of(self, words))[1])
    assert np.allclose(toxicity.Network(net.words, net.p).scores(texts), whole, atol=1e-5)
    assert sum(sizes) == 56 and max(sizes) == 5


@pytest.mark.parametrize(("operator", "keep"), [(quality_gam, "keep_good"), (toxicity, "keep_clean")])
def test_kept_rows_come_of_batches_bounded_in_bytes(spark, labels, monkeypatch, operator, keep):
    monkeypatch.setattr(toxicity, "READINGS", 1000)
    seen, written = [], operator.written
    monkeypatch.setattr(operator, "written", lambda df, purpose, **how: (seen.append(how), written(df, purpose, **how))[1])
    kept = getattr(operator, keep)(documents(spark, SF).limit(20), labels)
    assert seen == [{"batch_bytes": 4 << 20}] and kept.columns == documents(spark, SF).columns and 0 < kept.count() <= 20


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.9


def test_every_letter_of_a_long_word_is_read():
    word = "".join(chr(0x4E00 + i) for i in range(203))
    inputs = toxicity.words_of(f"short {word} end")
    assert inputs[0] == "short" and inputs[-1] == "end" and max(map(len, inputs)) == 64
    assert set("".join(inputs[1:-1])) == set(word)
    assert all(a[32:] == b[: len(a) - 32] for a, b in zip(inputs[1:-2], inputs[2:-1]))
    assert [len(toxicity.words_of("x" * n)) for n in (1, 64, 65, 96, 97)] == [1, 1, 2, 2, 3]


def test_training_reads_every_window(monkeypatch):
    """Toxic passages stand in any one of over a hundred windows of long texts."""
    monkeypatch.setattr(toxicity, "READINGS", 60)
    seen = set()
    odds = toxicity.Network.window_odds

    def spied(net, xf, xb, mask):
        seen.add(xf.shape[1])
        return odds(net, xf, xb, mask)

    monkeypatch.setattr(toxicity.Network, "window_odds", spied)
    toxicity.fit([["good day " * 1000], ["bad day " * 1000]], np.array([0, 1], dtype=np.float32))
    assert seen == {2 * len(toxicity.windows(np.arange(2000)))}
