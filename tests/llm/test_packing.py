from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from oreworks.llm import packing

from .conftest import documents

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def ids_of(library, text):
    return [*(library.encode(text, add_special_tokens=False).ids if text else []), 1]


def check_packed(rows, docs, library):
    want = sorted(
        (i, k // 4096, k, len(p), zlib.crc32(np.array(p, dtype="<u4").tobytes()))
        for i, t in docs
        for ids in [ids_of(library, t)]
        for k in range(0, len(ids), 4096)
        for p in [ids[k : k + 4096]]
    ) if all(i is not None for i, _ in docs) else None
    if want is not None:
        assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    spans = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    last = None
    for seq, offset, length in spans:
        assert offset == (0 if last is None or last[0] != seq else last[1])
        last = seq, offset + length
        assert last[1] <= 4096


def test_encoder_equals_the_library(library):
    encoder = packing.encoder_of(FILE)
    rnd = random.Random(2)
    letters = list("abcdefABC  \n\t'sdtreSTX019.,!?_éÑßÜİıΣσ–漢字🙂\x1c\x85́²½ªǅŉ<|>") + ["<|endoftext|>", "'ll", "aaaa", "__"]
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))
        assert encoder.encode(text) == np.array(ids_of(library, text)[:-1], dtype="<u4").tobytes(), text


def test_encoder_forgets_and_learns_again(library, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 50)
    encoder = packing.WordEncoder(FILE)
    for k in range(30):
        text = " ".join(f"w{chr(97 + (k + i) % 26) * (i % 7 + 1)}x" for i in range(60)) + " " + "long" * 40
        assert encoder.encode(text) == np.array(ids_of(library, text)[:-1], dtype="<u4").tobytes()


def test_encoder_keeps_the_words_in_use(monkeypatch):
    """Of two generations of words the older goes, and a word that every text holds is encoded once."""
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 40)
    encoder, learned = packing.WordEncoder(FILE), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda parts, plain: (learned.extend(parts), learn(parts, plain)))
    for k in range(60):
        encoder.encode("always " + " ".join("w" + chr(97 + k % 26) * (k // 26 + 1) + chr(97 + i) for i in range(5)))
        assert len(encoder.known) + len(encoder.older) <= 40
    assert learned.count("always") == 1 and len(learned) == 301


def test_batches_of_pieces_are_small(monkeypatch):
    """However many texts come in one batch; a batch of ids ends with the text that reaches the bound."""
    monkeypatch.setattr(packing, "BATCH_BYTES", 1000)
    monkeypatch.setattr(packing, "TEXTS", 20)
    texts = [None if n % 11 == 0 else "x" * (n % 90) for n in range(200)] + ["y" * 5000]
    batch = pa.RecordBatch.from_pydict({"doc_id": [*range(200), None], "text": texts})
    out = list(packing.cut_batches(iter([batch, batch.slice(0, 0)]), lambda t: t.encode() * 4, b"end.", 64))
    sizes = [sum(map(len, b.column("ids").to_pylist())) for b in out]
    assert max(sizes[:-1]) < 1000 + 4 * 90 and len(out) > 30 and all(b.num_rows for b in out)
    whole = {}
    for r in (r for b in out for r in b.to_pylist()):
        assert r["start"] == r["piece"] * 64 and len(r["ids"]) == 4 * r["length"] <= 256
        whole[r["doc_id"]] = whole.get(r["doc_id"], b"") + r["ids"]
    assert whole == {n: (t or "").encode() * 4 + b"end." for n, t in zip([*range(200), None], texts, strict=True)}


def best_fit(lengths, size):
    """Best-fit-decreasing one document at a time: room left per sequence."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        at = bisect_left(rooms, n)
        left = rooms.pop(at) if at < len(rooms) else size
        insort(rooms, left - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_over_counts_equals_best_fit_over_documents(seed):
    rnd = random.Random(seed)
    size = rnd.choice([8, 64, 4096])
    lengths = [min(size, max(1, int(rnd.expovariate(4 / size)) + 1)) for _ in range(rnd.randint(1, 400))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.best_fit_plan(histogram, size)
    filled = {}
    for n in histogram:
        ranks = sorted(k for s in plan if s.length == n for k in range(s.first_rank, s.first_rank + s.n))
        assert ranks == list(range(histogram[n]))
    for s in plan:
        for k in range(s.n):
            filled.setdefault(s.sequence + k, []).append((s.offset, s.length))
    for parts in filled.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= size
    assert len(filled) == best_fit(lengths, size)


def test_plan_is_small_for_many_documents():
    plan = packing.best_fit_plan({n: 10**9 + n for n in range(1, 4097)})
    assert len(plan) < packing.BROADCAST_PLAN_ROWS
    with pytest.raises(ValueError):
        packing.best_fit_plan({5000: 1})


def test_documents(spark, sf_dir, library):
    docs = documents(spark, sf_dir)
    rows = packing.packed_documents(docs, FILE).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], library)


def test_awkward_rows(awkward, no_docs, library):
    rows = packing.packed_documents(awkward, FILE).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in awkward.collect()], library)
    assert sorted(r.length for r in rows if r.doc_id in (2, 3, 4)) == [1, 1, 1]
    assert [r.length for r in sorted(rows, key=lambda r: r.piece) if r.doc_id == 7] == [4096, 1905]
    assert packing.packed_documents(no_docs, FILE).count() == 0


def test_other_columns_pass_through(spark):
    pieces = spark.createDataFrame([("a", 3, 1), ("b", 2, 2), ("c", 3, 3)], "name string, length long, rank int")
    got = packing.pack(pieces, 5)
    assert got.columns == ["name", "length", "rank", "sequence_id", "offset"]
    assert {r.name for r in got.collect()} == {"a", "b", "c"} and got.select("sequence_id").distinct().count() == 2


def test_ids_are_kept_whole(awkward, library):
    rows = packing.token_pieces(awkward.where("doc_id = 7"), FILE).collect()
    ids = b"".join(bytes(r.ids) for r in sorted(rows, key=lambda r: r.piece))
    assert np.frombuffer(ids, dtype="<u4").tolist() == ids_of(library, "word " * 6000)
