"""Toxicity: a bidirectional gated recurrent network with attention pooling over windows of words.

A word's input is its own vector and the mean of the vectors of its character pieces, so that unseen forms of known stems are
read too. Two recurrent passes, one from each end, give a state per word; attention weighs the states of
a window into one, from which a log-odds is read. A document's score is that of its worst window; all windows of
the whole text are scored, each overlapping the next by half. Trained in numpy on a bounded sample.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm.common import BATCH_BYTES, crc_remainder, enter_worker, labelled_sample, leave_worker, written

FOLDS, HELD_OUT = 4, 2
REJECT_FROM = 0.3
WINDOW, STRIDE = 32, 16
HIDDEN = 8
WIDTH = 12
# Words of the sample that get a vector of their own; all others are read by their characters.
LEAST_USES, MOST_WORDS = 8, 20_000
CHAR_ROWS = 1 << 14
# Labelled documents a model is fitted on at most. Training and scoring read all windows.
SAMPLE_ROWS = 4_000
# Documents read while training, over all passes: a small sample is read more often.
READINGS = 16_000
BATCH_DOCS = 32
RATE = 0.008
# Share of words whose own vector is left out of a step, so that characters are learned too, and
# windows of a clean document that a step learns from (of a toxic one its worst only). Through the first
# share of the readings a step takes that many windows of any document at random, to find out which words tell.
LEFT_OUT = 0.5
CLEAN_WINDOWS = 3
FIRST_SHARE = 0.5
# Windows scored at a time, and the bound of a worker's memory of word inputs.
SCORE_WINDOWS = 2048
REMEMBERED_WORDS = 200_000
# Words whose inputs are made at once: each has some twenty pieces.
NEW_WORDS = 4096

WORD = re.compile(r"[^\W\d_]+")


# A longer run of letters is read as inputs of this length, each overlapping the next by half.
LONGEST = 64


def words_of(text: str | None) -> list[str]:
    words = WORD.findall((text or "").lower())
    if max(map(len, words), default=0) <= LONGEST:
        return words
    half = LONGEST // 2
    return [w[i : i + LONGEST] for w in words for i in range(0, max(len(w) - half, 1), half)]


def char_pieces(word: str) -> list[int]:
    """Rows of the three- and four-character pieces of a marked word."""
    data = f"<{word}>".encode()
    return [zlib.crc32(data[i : i + n]) % CHAR_ROWS for n in (3, 4, 5) for i in range(max(len(data) - n + 1, 1))]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows per group number below n, column by column."""
    group = group.ravel()
    return np.stack([np.bincount(group, column, n) for column in values.T], axis=1).astype(np.float32)


@dataclass
class Network:
    """Parameters by name, and the words with a vector of their own (row 0: none)."""

    words: dict[str, int]
    p: dict[str, np.ndarray]
    offset: float = 0.0
    _known: dict[str, int] = field(default_factory=dict, repr=False)
    _inputs: np.ndarray | None = field(default=None, repr=False)

    @classmethod
    def fresh(cls, words: dict[str, int], rate: float, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-2] if len(shape) > 1 else 1)).astype(np.float32)
        p = {"word": small(len(words) + 1, WIDTH) * 0.3, "char": small(CHAR_ROWS, WIDTH) * 20}
        p["word"][0] = 0
        for d in "fb":
            p |= {f"W{d}": small(2 * WIDTH, 3 * HIDDEN), f"U{d}": small(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        p |= {"v": small(2 * HIDDEN, 1)[:, 0], "u": small(2 * HIDDEN, 1)[:, 0], "b": np.array([np.log(rate / (1 - rate))], np.float32)}
        return cls(words, p)

    def inputs_of(self, words: list[str]) -> np.ndarray:
        """Input vectors: word, then mean of its character pieces."""
        rows = np.array([self.words.get(w, 0) for w in words], dtype=np.int64)
        return self.inputs_from(rows, [char_pieces(w) for w in words])

    def inputs_from(self, rows: np.ndarray, pieces: list) -> np.ndarray:
        out = np.zeros((len(rows), 2 * WIDTH), np.float32)
        out[:, :WIDTH] = self.p["word"][rows]
        if len(rows):
            sizes = np.array([len(x) for x in pieces])
            sums = np.add.reduceat(self.p["char"][np.concatenate(pieces)], np.r_[0, sizes.cumsum()[:-1]])
            out[:, WIDTH:] = sums / sizes[:, None]
        return out

    # -- forward -------------------------------------------------------------------

    def _pass(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """x (time, n, 3 hidden) projected inputs -> states (time, n, hidden), from the end for ``b``."""
        u = self.p[f"U{d}"]
        n = x.shape[1]
        h = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((len(x), n, HIDDEN), np.float32)
        for t in range(len(x)) if d == "f" else reversed(range(len(x))):
            ru = h @ u
            gates = _sigmoid(x[t, :, : 2 * HIDDEN] + ru[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            new = np.tanh(x[t, :, 2 * HIDDEN :] + r * ru[:, 2 * HIDDEN :])
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, h, z, r, new, ru, m))
            h = h + m * z * (new - h)
            out[t] = h
        return out

    def _pooled(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = states @ self.p["v"] + np.where(mask, 0, -1e9)
        a = np.exp(at - at.max(0)) * mask
        a /= np.maximum(a.sum(0), 1e-9)
        return (a[:, :, None] * states).sum(0), a

    def window_odds(self, xf: np.ndarray, xb: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._pass(xf, mask, "f"), self._pass(xb, mask, "b")], axis=2)
        return self._pooled(states, mask)[0] @ self.p["u"] + self.p["b"][0]

    # -- scoring -------------------------------------------------------------------

    def _ids(self, words: list[str]) -> np.ndarray:
        """Rows of the remembered projected inputs, both directions side by side; row 0 is no word."""
        new = [w for w in set(words) if w not in self._known]
        if self._inputs is None or len(self._known) + len(new) > REMEMBERED_WORDS:
            self._known, self._inputs = {}, np.zeros((1, 6 * HIDDEN), np.float32)
            new = list(set(words))
        if new:
            start = len(self._known) + 1
            if start + len(new) > len(self._inputs):
                # Grown by doubling, so that the rows are seldom copied.
                more = np.zeros((max(start + len(new), 2 * len(self._inputs)) - len(self._inputs), 6 * HIDDEN), np.float32)
                self._inputs = np.concatenate([self._inputs, more])
            for i in range(0, len(new), NEW_WORDS):
                x = self.inputs_of(new[i : i + NEW_WORDS])
                both = [x @ self.p[f"W{d}"] + self.p[f"c{d}"] for d in "fb"]
                self._inputs[start + i : start + i + len(x)] = np.concatenate(both, axis=1)
            self._known.update(zip(new, range(start, start + len(new)), strict=True))
        return np.fromiter(map(self._known.__getitem__, words), np.int64, len(words))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Of the worst window of each text; an empty text has one empty window."""
        worst = np.full(len(texts), -np.inf)
        at = 0
        while at < len(texts):  # texts by the hundred thousand words, so that memory is bounded
            split, n = [], 0
            while at + len(split) < len(texts) and n < 100_000:
                split.append(words_of(texts[at + len(split)]))
                n += len(split[-1])
            rows = self._ids([w for s in split for w in s])
            first = 0
            ids, owner = [], []
            for k, words in enumerate(split, at):
                ids.append(windows(rows[first : first + len(words)]))
                owner.append(np.full(len(ids[-1]), k))
                first += len(words)
            ids, owner = np.concatenate(ids), np.concatenate(owner)
            at += len(split)
            for i in range(0, len(ids), SCORE_WINDOWS):
                some = ids[i : i + SCORE_WINDOWS].T
                x = self._inputs[some]
                odds = self.window_odds(x[:, :, : 3 * HIDDEN], x[:, :, 3 * HIDDEN :], some > 0)
                np.maximum.at(worst, owner[i : i + SCORE_WINDOWS], odds)
        return _sigmoid(np.clip(worst, -30, 30))


def windows(ids: np.ndarray) -> np.ndarray:
    """All windows of WINDOW ids, every STRIDE; the last one padded with 0. No id: one empty window."""
    n = len(ids)
    count = max(0, -(-(n - WINDOW) // STRIDE)) + 1
    padded = np.zeros((count - 1) * STRIDE + WINDOW, np.int64)
    padded[:n] = ids
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


# -- training ----------------------------------------------------------------------


class _Trainer:
    """Adam steps on the worst window of each document."""

    def __init__(self, net: Network):
        self.net, self.step = net, 0
        self.m = {k: np.zeros_like(v) for k, v in net.p.items()}
        self.s = {k: np.zeros_like(v) for k, v in net.p.items()}

    def _back(self, d: str, grad: np.ndarray, kept: list, x_in: np.ndarray, g: dict) -> np.ndarray:
        """Gradient of the states -> gradient of the inputs, adding those of the weights."""
        p = self.net.p
        w, u = p[f"W{d}"], p[f"U{d}"]
        dx = np.empty(x_in.shape, np.float32)
        dh = np.zeros(grad.shape[1:], np.float32)
        for t, h, z, r, new, ru, m in reversed(kept):
            dh = dh + grad[t]
            dz, dnew = dh * m * (new - h), dh * m * z
            da = dnew * (1 - new**2)
            back = dh * (1 - m * z)
            dgate = np.concatenate([dz * z * (1 - z), da * ru[:, 2 * HIDDEN :] * r * (1 - r), da], axis=1)
            du = dgate.copy()
            du[:, 2 * HIDDEN :] *= r
            g[f"U{d}"] += h.T @ du
            g[f"W{d}"] += x_in[t].T @ dgate
            g[f"c{d}"] += dgate.sum(0)
            dx[t] = dgate @ w.T
            dh = back + du @ u.T
        return dx

    def learn(self, ids: np.ndarray, y: np.ndarray, vocabulary: np.ndarray, pieces: list[np.ndarray], inputs: np.ndarray) -> None:
        """ids (time, n) of word numbers, 0 for none; per word number its row of the word table, its pieces and its input."""
        net, p = self.net, self.net.p
        mask = ids > 0
        x_in = inputs[ids]
        kept: dict[str, list] = {"f": [], "b": []}
        states = [net._pass(x_in @ p[f"W{d}"] + p[f"c{d}"], mask, d, kept[d]) for d in "fb"]
        both = np.concatenate(states, axis=2)
        pooled, a = net._pooled(both, mask)
        prob = _sigmoid(pooled @ p["u"] + p["b"][0])
        dodds = ((prob - y) / len(y)).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "char")}
        g["u"] = pooled.T @ dodds
        g["b"] = np.array([dodds.sum()], np.float32)
        dpooled = dodds[:, None] * p["u"]
        along = (both * dpooled).sum(2)
        dat = a * (along - (a * along).sum(0))
        g["v"] = (dat[:, :, None] * both).sum((0, 1))
        dboth = a[:, :, None] * dpooled + dat[:, :, None] * p["v"]
        dx = self._back("f", dboth[:, :, :HIDDEN], kept["f"], x_in, g) + self._back("b", dboth[:, :, HIDDEN:], kept["b"], x_in, g)
        used, where = np.unique(ids[mask], return_inverse=True)
        per_word = _sums(where, dx[mask], len(used))
        self.step += 1
        for k, grad in g.items():
            self._adam(k, slice(None), grad)
        rows = vocabulary[used]
        own = rows > 0
        self._adam("word", rows[own], per_word[own, :WIDTH])
        of = [pieces[i] for i in used]
        if of:
            sizes = np.array([len(x) for x in of])
            touched, at = np.unique(np.concatenate(of), return_inverse=True)
            share = np.repeat(per_word[:, WIDTH:] / sizes[:, None], sizes, axis=0)
            self._adam("char", touched, _sums(at, share, len(touched)))

    def _adam(self, k: str, at, grad: np.ndarray) -> None:
        m = self.m[k][at] * 0.9 + 0.1 * grad
        s = self.s[k][at] * 0.99 + 0.01 * grad**2
        self.m[k][at], self.s[k][at] = m, s
        self.net.p[k][at] -= RATE * (m / (1 - 0.9**self.step)) / (np.sqrt(s / (1 - 0.99**self.step)) + 1e-6)


def _odds(net: Network, inputs: np.ndarray, ids: np.ndarray) -> np.ndarray:
    x = inputs[ids]
    return net.window_odds(x @ net.p["Wf"] + net.p["cf"], x @ net.p["Wb"] + net.p["cb"], ids > 0)


def fit(samples: list[list[str]], y: np.ndarray, seed: int = 7) -> Network:
    """Learns from all windows of labelled texts, given as runs of space-joined words. Without both labels every score is the label mean, near 0 without labels."""
    number: dict[str, int] = {}
    docs, uses = [], Counter()
    for runs in samples:
        ids = np.array([number.setdefault(w, len(number) + 1) for run in runs for w in run.split()], np.int64)
        docs.append(windows(ids))
        uses.update(np.unique(ids).tolist())
    names = list(number)
    own = sorted((i for i, n in uses.items() if n >= LEAST_USES), key=lambda i: (-uses[i], names[i - 1]))[:MOST_WORDS]
    rate = float(np.clip(y.sum() / (len(y) + 2), 1e-3, 1 - 1e-3))
    net = Network.fresh({names[i - 1]: k + 1 for k, i in enumerate(own)}, rate, seed)
    if len(y) < 2 or y.min() == y.max():
        net.p["u"][:] = 0
        return net
    pieces = [np.empty(0, np.int64), *[np.array(char_pieces(w)) for w in names]]
    vocabulary = np.array([0, *[net.words.get(w, 0) for w in names]])
    rng = np.random.default_rng(seed)
    trainer = _Trainer(net)
    passes = max(1, -(-READINGS // len(docs)))
    for number_of_pass in range(passes):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH_DOCS):
            some = order[at : at + BATCH_DOCS]
            picked = [docs[i] for i in some]
            if number_of_pass < FIRST_SHARE * passes:
                picked = [w[rng.permutation(len(w))[:CLEAN_WINDOWS]] for w in picked]
            used, ids = np.unique(np.concatenate(picked), return_inverse=True)
            ids = ids.reshape(-1, WINDOW).T + (used[0] > 0)
            used = used if used[0] == 0 else np.concatenate([[0], used])
            own_rows = np.where(rng.random(len(used)) < LEFT_OUT, 0, vocabulary[used])
            inputs = np.zeros((len(used), 2 * WIDTH), np.float32)
            inputs[1:] = net.inputs_from(own_rows[1:], [pieces[i] for i in used[1:]])
            if number_of_pass < FIRST_SHARE * passes:
                truth = np.repeat(y[some], [len(w) for w in picked])
                trainer.learn(ids, truth, own_rows, [pieces[i] for i in used], inputs)
                continue
            odds = np.concatenate([_odds(net, inputs, ids[:, i : i + SCORE_WINDOWS]) for i in range(0, ids.shape[1], SCORE_WINDOWS)])
            first, worst, truth = 0, [], []
            for k, w in zip(some, picked, strict=True):
                top = np.argsort(-odds[first : first + len(w)], kind="stable")[: 1 if y[k] else CLEAN_WINDOWS]
                worst += (first + top).tolist()
                truth += [y[k]] * len(top)
                first += len(w)
            trainer.learn(ids[:, worst], np.array(truth, np.float32), own_rows, [pieces[i] for i in used], inputs)
    return net


# -- on tables ---------------------------------------------------------------------


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """Fits on at most SAMPLE_ROWS labelled documents outside the held-out fold; NULL labels and labels without a document are left out."""
    sample = labelled_sample(labels, "toxic", FOLDS, HELD_OUT, SAMPLE_ROWS)
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most SAMPLE_ROWS ids
    run_of = F.pandas_udf(lambda texts: texts.map(lambda t: " ".join(words_of(t))), "string")
    rows = joined.select("doc_id", "y", run_of("text").alias("run")).orderBy("doc_id").collect()
    net = fit([[r.run] for r in rows], np.array([r.y for r in rows], dtype=np.float32))
    rows = None
    leave_worker()  # the driver waits for the next stages without what training has freed
    return net


def _score_udf(net: Network):
    shared = net.p, net.words

    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enter_worker("toxicity")
        own = Network(shared[1], shared[0])
        for batch in texts:
            yield pd.Series(own.scores(list(batch)), dtype="float64")
        batch = own = None
        leave_worker()

    return F.pandas_udf(scored, "double")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, ..) -> doc_id, held_out, score, predicted (1 if score >= 0.3), one row per row of docs.

    NULL and empty texts and texts without letters get the score of an empty window. A NULL id is not held out.
    """
    score = _score_udf(train(docs, labels))
    return docs.select(
        "doc_id",
        F.coalesce(crc_remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        score("text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= REJECT_FROM).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs whose text scores below 0.3, all columns. Written, as only then are the batches of texts bounded in bytes."""
    score = _score_udf(train(docs, labels))
    return written(docs.where(score("text") < REJECT_FROM), "clean", batch_bytes=BATCH_BYTES)
