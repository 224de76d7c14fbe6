"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text fall into bins. Boosting goes round the features in turn, a shallow
tree on one feature's bins each time, and adds its leaves to that feature's lookup table; chosen pairs of
features get tables of coarse bins in the same way. A score is a sum of table entries. Trained in numpy
on a bounded sample, scored per batch by adding bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm.common import BATCH_BYTES, crc_remainder, enter_worker, labelled_sample, leave_worker, written

FOLDS, HELD_OUT = 5, 0
REJECT_BELOW = 0.3
# Labelled documents a model is fitted on at most; what is fitted does not depend on the rest of the corpus.
SAMPLE_ROWS = 12_000
BINS = 48
COARSE = 8
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 8
RATE = 0.1
LEAST_LEAF = 8
# Log-odds are shrunk by this many made-up rows per leaf.
SHRINK = 2.0

FEATURES = [
    "log_bytes", "log_words", "mean_word", "longest_word", "upper_share", "digit_share", "blank_share", "other_ascii_share",
    "non_ascii_share", "pipe_share", "symbol_share", "bang_share", "stop_share", "comma_share", "newline_rate", "distinct_words",
    "repeated_neighbours", "distinct_lines", "words_ending_other", "short_words",
]

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "blank": b" \t\n\r\x0b\x0c",
    "pipe": b"|",
    "symbol": b"#$%&*@^~=+<>{}[]\\",
    "bang": b"!?",
    "stop": b".",
    "comma": b",;:",
}
_LETTERS = b"abcdefghijklmnopqrstuvwxyz"


def text_features(text: str | None) -> np.ndarray:
    """One number per name in FEATURES; a NULL, empty or blank text has zeros where nothing can be measured."""
    data = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(len(FEATURES), dtype=np.float32)
    if not data:
        return out
    n = len(data)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    share = {name: counts[list(chars)].sum() / n for name, chars in _CLASSES.items()}
    ascii_share = counts[:128].sum() / n
    letters = counts[list(_LETTERS)].sum() / n
    words = data.split()
    m = max(len(words), 1)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    lines = [line for line in data.split(b"\n") if line.strip()]
    ends = b"".join([w[-1:] for w in words])
    letter_ends = sum(map(ends.count, (bytes([c]) for c in _LETTERS + b".,")))
    out[:] = [
        np.log1p(n),
        np.log1p(len(words)),
        lengths.mean() if len(words) else 0,
        lengths.max() if len(words) else 0,
        share["upper"],
        share["digit"],
        share["blank"],
        ascii_share - letters - share["upper"] - share["digit"] - share["blank"],
        1 - ascii_share,
        share["pipe"],
        share["symbol"],
        share["bang"],
        share["stop"],
        share["comma"],
        counts[10] / m,
        len(set(words)) / m,
        sum(map(bytes.__eq__, words, words[1:])) / m,
        len(set(lines)) / max(len(lines), 1),
        1 - letter_ends / m,
        (lengths <= 2).sum() / m if len(words) else 0,
    ]
    return out


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables: one per feature, one per pair of coarsely binned features."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, j], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            a = np.searchsorted(self.coarse[i], x[:, i], side="right")
            b = np.searchsorted(self.coarse[j], x[:, j], side="right")
            out += table[a, b]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between quantiles; equal values stay together."""
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(gradient: float, weight: float) -> float:
    return gradient / (weight + SHRINK)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """Value per bin of a shallow tree over ordered bins: splits that gain most, leaves of LEAST_LEAF rows."""
    out = np.full(len(g), _leaf(g.sum(), h.sum()))
    if depth == 0 or len(g) < 2:
        return out
    gl, hl, nl = g.cumsum()[:-1], h.cumsum()[:-1], n.cumsum()[:-1]
    gain = gl**2 / (hl + SHRINK) + (g.sum() - gl) ** 2 / (h.sum() - hl + SHRINK) - g.sum() ** 2 / (h.sum() + SHRINK)
    gain[(nl < LEAST_LEAF) | (n.sum() - nl < LEAST_LEAF)] = -1
    at = int(gain.argmax())
    if gain[at] <= 1e-9:
        return out
    return np.concatenate([_tree(g[: at + 1], h[: at + 1], n[: at + 1], depth - 1), _tree(g[at + 1 :], h[at + 1 :], n[at + 1 :], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Best cut in each direction: four leaves on a grid, and their gain."""
    corner_g, corner_h = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a, b = corner_g[:-1, :-1], corner_h[:-1, :-1]
    top, top_h = corner_g[:-1, -1:], corner_h[:-1, -1:]
    left, left_h = corner_g[-1:, :-1], corner_h[-1:, :-1]
    all_g, all_h = corner_g[-1, -1], corner_h[-1, -1]
    parts = [(a, b), (top - a, top_h - b), (left - a, left_h - b), (all_g - top - left + a, all_h - top_h - left_h + b)]
    gain = sum(x**2 / (y + SHRINK) for x, y in parts)
    out = np.zeros_like(g)
    if not gain.size:
        return out, 0.0
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    quarters = [np.s_[: i + 1, : j + 1], np.s_[: i + 1, j + 1 :], np.s_[i + 1 :, : j + 1], np.s_[i + 1 :, j + 1 :]]
    for at in quarters:
        out[at] = _leaf(g[at].sum(), h[at].sum())
    return out, float(gain[i, j])


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of the logistic loss. With one label only, scores are the label mean; without labels they are near 1."""
    n, k = x.shape
    mean = float(np.clip((y.sum() + 2) / (n + 2), 1e-3, 1 - 1e-3))
    base = float(np.log(mean / (1 - mean)))
    edges = [_edges(x[:, j], BINS) if n else np.empty(0) for j in range(k)]
    coarse = [_edges(x[:, j], COARSE) if n else np.empty(0) for j in range(k)]
    model = AdditiveModel(base, edges, [np.zeros(len(e) + 1) for e in edges], coarse, [], [])
    if n < 2 or y.min() == y.max():
        return model
    bins = [np.searchsorted(edges[j], x[:, j], side="right") for j in range(k)]
    sizes = [len(e) + 1 for e in edges]
    rows_in = [np.bincount(b, minlength=s).astype(float) for b, s in zip(bins, sizes, strict=True)]
    odds = np.full(n, base)
    for _ in range(ROUNDS):
        for j in range(k):
            p = 1 / (1 + np.exp(-odds))
            g = np.bincount(bins[j], y - p, minlength=sizes[j])
            h = np.bincount(bins[j], p * (1 - p), minlength=sizes[j])
            step = RATE * _tree(g, h, rows_in[j])
            model.tables[j] += step
            odds += step[bins[j]]
    rough = [np.searchsorted(coarse[j], x[:, j], side="right") for j in range(k)]
    widths = [len(c) + 1 for c in coarse]

    def grids(i: int, j: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell, shape = rough[i] * widths[j] + rough[j], (widths[i], widths[j])
        cells = shape[0] * shape[1]
        g = np.bincount(cell, y - p, minlength=cells).reshape(shape)
        h = np.bincount(cell, p * (1 - p), minlength=cells).reshape(shape)
        return g, h, cell

    p = 1 / (1 + np.exp(-odds))
    gains = sorted(((_pair_tree(*grids(i, j, p)[:2])[1], i, j) for i, j in combinations(range(k), 2)), reverse=True)
    model.pairs = [(i, j) for _, i, j in gains[:PAIRS]]
    model.pair_tables = [np.zeros((widths[i], widths[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            g, h, cell = grids(i, j, 1 / (1 + np.exp(-odds)))
            step = RATE * _pair_tree(g, h)[0]
            table += step
            odds += step.ravel()[cell]
    return model


# -- on tables ---------------------------------------------------------------------


def _features_udf():
    def measured(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enter_worker("quality")
        for batch in texts:
            yield pd.Series([text_features(t) for t in batch], dtype=object)

    return F.pandas_udf(measured, "array<float>")


def train(docs: DataFrame, labels: DataFrame) -> AdditiveModel:
    """Fits on at most SAMPLE_ROWS labelled documents outside the held-out fold; NULL labels and labels without a document are left out."""
    sample = labelled_sample(labels, "quality", FOLDS, HELD_OUT, SAMPLE_ROWS)
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most SAMPLE_ROWS ids
    rows = joined.select("doc_id", "y", _features_udf()("text").alias("x")).orderBy("doc_id").collect()
    x = np.array([r.x for r in rows], dtype=np.float32).reshape(len(rows), len(FEATURES))
    model = fit(x, np.array([r.y for r in rows], dtype=float))
    rows = x = None
    leave_worker()  # the driver waits for the next stages without what training has freed
    return model


def _score_udf(model: AdditiveModel):
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enter_worker("quality")
        for batch in texts:
            x = np.stack([text_features(t) for t in batch]) if len(batch) else np.empty((0, len(FEATURES)))
            yield pd.Series(model.scores(x))
        batch = x = None
        leave_worker()

    return F.pandas_udf(scored, "double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, ..) -> doc_id, held_out, score, predicted (1 if score >= 0.3), one row per row of docs.

    NULL and empty texts get the score of an empty text. A NULL id is not held out.
    """
    score = _score_udf(train(docs, labels))
    return docs.select(
        "doc_id",
        F.coalesce(crc_remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        score("text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= REJECT_BELOW).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs whose text scores at least 0.3, all columns. Written, as only then are the batches of texts bounded in bytes."""
    score = _score_udf(train(docs, labels))
    return written(docs.where(score("text") >= REJECT_BELOW), "good", batch_bytes=BATCH_BYTES)
