"""Ranked lexical search over K2-treaps of the term-document grid.

Each task deals its documents into blocks. A block's grid has a row per term and a column per document; a quadtree over it
keeps, for every cell that holds anything, which of its four quarters do and the largest impact below. A search follows
the row paths of all its terms together from the root down: a range of columns is bounded by the sum over the terms of weight times the largest impact
of the cell that the term's path meets there, and ranges whose bound is below the k-th best score so far are left
out. Ranges are taken best first, in growing groups; at the leaves bounds are scores. Impacts hold no term weights, so one tree serves all searches. Rows are ordered
by frequency and columns by length, so that neighbours in a cell are alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreworks.llm.byte_tokens import text_slices
from oreworks.llm.common import enter_worker, with_rank, written

# Items searched in one pass over the documents; their terms and best documents are held by every task.
ITEMS_AT_ONCE = 2000
# Columns of a block; its text is bounded as well (byte_tokens.SLICE_BYTES), to one document at least.
BLOCK_COLUMNS = 8192
# Levels above the leaves at which ranges are taken best first, and how many are taken at first.
RANGE_BITS, FIRST_RANGES = 5, 8

# Of each UTF-8 byte the byte it stands for in a term, 0 if it ends one: ASCII letters in lower case, digits, and all bytes of other characters.
_BYTES = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 0 for b in range(256)], np.uint8)
_ONES = np.array([x.bit_count() for x in range(16)], np.int64)


# -- terms -------------------------------------------------------------------------


def terms_of(texts: pa.StringArray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of the texts in order, and the text each belongs to. NULL has none."""
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = _BYTES[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]] if data else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = data != 0
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    opens[borders] = inside[borders]
    at = np.flatnonzero(opens)
    ends = np.append(np.cumsum(inside)[at] - 1, np.count_nonzero(inside)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data[inside].tobytes())])
    return words.dictionary_encode(), np.searchsorted(offsets, at, "right") - 1


def _counted(docs: DataFrame, terms: list[bytes]) -> tuple[int, int, list[int]]:
    """Documents with a term, all their terms, and per given term the documents that hold it."""
    wanted = pa.array(terms, pa.binary())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, totals = np.zeros(len(terms), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for some in text_slices(batch, "text"):
                words, doc = terms_of(some.column("text"))
                totals += len(np.unique(doc)), len(doc)
                number = pc.fill_null(pc.index_in(words.dictionary, wanted), -1).to_numpy()[words.indices.to_numpy()]
                pairs = np.unique(doc[number >= 0] * len(terms) + number[number >= 0])
                held += np.bincount(pairs % max(1, len(terms)), minlength=len(terms))
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *at]), pa.array([*totals, *held[at]])], ["term", "n"])

    counts = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in counts.collect()}  # a row per term of the items, and two
    return found.get(-2, 0), found.get(-1, 0), [found.get(k, 0) for k in range(len(terms))]


# -- tree --------------------------------------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of numbers below 2^31 moved to the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x.astype(np.int64)


class K2Treap:
    """Quadtree of distinct cells (row, column) with positive values, level by level; ``size`` exceeds all rows and columns.

    quarters: of each cell of a level four bits, those of its quarters that hold anything. first: where these begin on the
    next level. largest: the largest value in each cell.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, size: int):
        self.height = max(1, int(size - 1).bit_length())
        codes = _spread(rows) << 1 | _spread(columns)
        order = np.argsort(codes)
        codes, largest = codes[order], values[order].astype(np.int32)
        self.largest, self.quarters, self.first = [largest], [], []
        for _ in range(self.height):
            above = codes >> 2
            first = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]]))
            self.quarters.insert(0, np.bitwise_or.reduceat((1 << (codes & 3)).astype(np.uint8), first))
            self.first.insert(0, first.astype(np.int32))
            largest = np.maximum.reduceat(largest, first)
            self.largest.insert(0, largest)
            codes = above[first]

    def _down(self, level: int, rows: np.ndarray, weights: np.ndarray, at: tuple[np.ndarray, ...], least: float) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        """From (range, term, cell) of a level to those of the next whose range may reach ``least``, and the bounds of all ranges there."""
        ranges, term, cell = at
        quarters, first = self.quarters[level][cell], self.first[level][cell]
        half = 2 * (rows[term] >> (self.height - 1 - level) & 1)
        parts = []
        for side in range(2):
            there = (quarters >> (half + side) & 1).astype(bool)
            before = _ONES[quarters[there] & ((1 << (half[there] + side)) - 1)]
            parts.append((2 * ranges[there] + side, term[there], first[there] + before))
        ranges, term, cell = (np.concatenate(x) for x in zip(*parts, strict=True))
        # Sums of whole numbers below 2^53 are exact in doubles.
        bounds = np.bincount(ranges, weights=self.largest[level + 1][cell] * weights[term])
        some = bounds[ranges] >= least
        return (ranges[some], term[some], cell[some]), bounds

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(columns, scores) of all columns that may be among the k best by the sum of weights times values, with scores above 0.

        known: the best scores so far, at most k; a column below the k-th of them is left out, a tie stays.
        """
        least = lambda: float(known.min()) if len(known) >= k else 1.0
        at = np.zeros(len(rows), np.int64), np.arange(len(rows)), np.zeros(len(rows), np.int64)
        stop = max(0, self.height - RANGE_BITS)
        bounds = np.full(1, np.inf)
        for level in range(stop):
            at, bounds = self._down(level, rows, weights, at, least())
        ranges = np.unique(at[0])
        ranges = ranges[np.argsort(-bounds[ranges], kind="stable")]
        columns, scores = [], []
        taken, n = 0, FIRST_RANGES
        while taken < len(ranges) and bounds[ranges[taken]] >= least():
            chosen = np.zeros(len(bounds), bool)
            chosen[ranges[taken : taken + n]] = True
            part = tuple(x[chosen[at[0]]] for x in at)
            for level in range(stop, self.height):
                part, exact = self._down(level, rows, weights, part, least())
            found = np.unique(part[0])
            columns.append(found)
            scores.append(exact[found] if len(found) else np.empty(0))
            known = np.sort(np.concatenate([known, scores[-1]]))[-k:]
            taken, n = taken + n, 2 * n
        found, score = (np.concatenate(x) if x else np.empty(0) for x in (columns, scores))
        some = score >= least()
        return found[some].astype(np.int64), score[some].astype(np.int64)


# -- search ------------------------------------------------------------------------


class Block:
    """Tree of some documents: impacts by length and the corpus's mean length."""

    def __init__(self, doc_ids: pa.Array, words: pa.DictionaryArray, doc: np.ndarray, n_docs: int, n_terms: int):
        lengths = np.bincount(doc, minlength=len(doc_ids))
        columns = np.argsort(lengths, kind="stable")
        columns = columns[lengths[columns] > 0]
        column_of = np.zeros(len(doc_ids), np.int64)
        column_of[columns] = np.arange(len(columns))
        self.doc_ids = doc_ids.take(pa.array(columns)).to_pylist()
        cells, tf = np.unique(words.indices.to_numpy().astype(np.int64) * len(columns) + column_of[doc], return_counts=True)
        term, column = np.divmod(cells, max(1, len(columns)))
        frequency = np.bincount(term, minlength=len(words.dictionary))
        self.row_of = np.empty(len(frequency), np.int64)
        self.row_of[np.argsort(-frequency, kind="stable")] = np.arange(len(frequency))
        self.terms = words.dictionary
        # Python's whole numbers, as the product may be long.
        norm = np.array([75 + 25 * n * n_docs // n_terms for n in lengths[columns].tolist()], np.int64)
        impacts = 1_000_000_000 * tf // (1000 * tf + 12 * norm[column])
        self.tree = K2Treap(self.row_of[term], column, impacts, max(len(columns), len(frequency), 2)) if len(columns) else None


class Best:
    """Of each item its k best documents so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.found = k, [([], np.empty(0))] * n_items

    def add(self, item: int, ids: list, scores: np.ndarray) -> None:
        rows, known = self.found[item]
        order = lambda x: (-x[1], x[0] is None, x[0] or 0)
        best = sorted([*rows, *zip(ids, scores.tolist(), strict=True)], key=order)[: self.k]
        self.found[item] = best, np.array([s for _, s in best], np.float64)


def _searched(docs: DataFrame, items: list[tuple[int, Counter]], k: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents of each item."""
    terms = sorted({t for _, own in items for t in own})
    n_docs, n_terms, held = _counted(docs, terms)
    number = {t: i for i, t in enumerate(terms)}
    weight = [floor(1000 * log((2 * n_docs + 2) / (2 * df + 1))) for df in held]
    asked = [(np.array([number[t] for t in own], np.int64), np.array([weight[number[t]] * n for t, n in own.items()], np.int64)) for _, own in items]
    wanted = pa.array(terms, pa.binary())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter_worker("k2_treap")
        best = Best(len(asked), k)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_COLUMNS):
                for some in text_slices(batch.slice(at, BLOCK_COLUMNS), "text"):
                    block = Block(some.column("doc_id"), *terms_of(some.column("text")), n_docs, n_terms)
                    if block.tree is None:
                        continue
                    there = pc.fill_null(pc.index_in(wanted, block.terms), -1).to_numpy()
                    for item, (own, weights) in enumerate(asked):
                        use = (there[own] >= 0) & (weights > 0)
                        if use.any():
                            columns, scores = block.tree.best(block.row_of[there[own[use]]], weights[use], k, best.found[item][1])
                            best.add(item, [block.doc_ids[c] for c in columns.tolist()], scores)
        for item, (rows, _) in enumerate(best.found):
            if rows:
                ids, scores = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([items[item][0]] * len(rows)), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, "item long, doc_id long, score long")


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(doc_id, text, ..) and (item_id, text, ..) -> item_id, rank, doc_id, score: of each item the k best documents with a score above 0.

    Equal scores are ranked by ascending doc_id, NULL ids last. Every row of the items is an item of its own, also if ids repeat; repeated
    documents are ranked one after the other. NULL and empty texts match nothing; texts of any length count as a whole. No documents or no
    items, no rows.
    """
    spark = docs.sparkSession
    numbered = written(with_rank(written(items.select("item_id", "text"), "items"), "item_id", "text", rank="item"), "numbered_items")
    n_items = numbered.count()
    parts = []
    for first in range(0, n_items, ITEMS_AT_ONCE):
        rows = numbered.where((F.col("item") >= first) & (F.col("item") < first + ITEMS_AT_ONCE)).orderBy("item").collect()
        words, of = terms_of(pa.array([r.text for r in rows], pa.string()))
        own: list[Counter] = [Counter() for _ in rows]
        for k_item, term in zip(of.tolist(), words.to_pylist(), strict=True):
            own[k_item][term] += 1
        asked = [(r.item, c) for r, c in zip(rows, own, strict=True) if c]
        if asked:
            parts.append(written(_searched(docs, asked, k), "found_documents"))
    found = spark.createDataFrame([], "item long, doc_id long, score long")
    for part in parts:
        found = found.unionByName(part)
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def oracle_sql(k: int = 20) -> str:
    """The same rows by joining all terms, for DuckDB."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all({lower}, '{pattern}')) AS term FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, corpus GROUP BY term, n_docs),
asked AS (SELECT item_id, unnest(regexp_extract_all({lower}, '{pattern}')) AS term FROM benchmark),
counted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM counted JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (doc_id), corpus GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= {k}
"""
