"""Best-fit packing by length histogram.

The plan is made over counts of lengths, of which there are at most as many as a
sequence has places; documents then take planned slots by joining on their
rank within their length. The driver sees the histogram and the plan, never a document.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oreworks.llm.common import BATCH_BYTES, enter_worker, leave_worker, local_table, with_rank, written

SEQUENCE = 4096
# A plan has a few rows per length; one within this bound is broadcast (32 bytes a row), a larger one is joined by shuffle.
BROADCAST_PLAN_ROWS = 200_000
# Bounds of a worker's memory of encoded words; what is forgotten is encoded anew.
REMEMBERED_WORDS = 300_000
REMEMBERED_CHARS = 48
# Texts taken out of a batch at once.
TEXTS = 100


# -- token ids ---------------------------------------------------------------------


class WordEncoder:
    """Ids of whole texts for a vocabulary of lower-case words that drops white space, as little-endian bytes.

    No token of such a vocabulary crosses a piece of the splitting pattern, so each distinct piece is encoded once and remembered, in two
    generations of half the bound: when the younger is full the older goes, and what was used since lies in the younger.
    Texts of other than plain characters are split at white space only, and those with separators that
    are no white space to the library are encoded whole.
    """

    # Fixed value: the vocabulary's own splitting pattern, as it applies to plain characters.
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
    # Letters whose case and form need no context, ASCII, and blanks: Latin-1 and Latin Extended but for a few signs.
    PLAIN = re.compile(r"[\t-\r -~¡-©«¬®¯°±´¶·¸»¿-įĲ-ƺƼ-ƿǄ-ɏ]*\Z")
    SEPARATORS = re.compile("[\x1c-\x1f]")

    def __init__(self, tokenizer_file: str):
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.specials = re.compile("|".join(map(re.escape, specials)) or "(?!)")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in found]

    def _learn(self, parts: list[str], plain: bool) -> None:
        """Plain pieces go many per call, and the last token of a piece bears the end mark."""
        for at in range(0, len(parts), 256):
            some = parts[at : at + 256]
            ids = self._ids([" ".join(some)])[0] if plain else np.empty(0, dtype="<u4")
            cuts = [0, *(np.flatnonzero(self.ends[ids]) + 1).tolist()]
            if plain and len(cuts) == len(some) + 1:
                data = ids.tobytes()
                found = [data[4 * i : 4 * j] for i, j in pairwise(cuts)]
            else:
                found = [i.tobytes() for i in self._ids(some)]
            self.known.update(zip(some, found, strict=True))

    def encode(self, text: str) -> bytes:
        plain = bool(self.PLAIN.match(text)) and not self.specials.search(text)
        if not plain and self.SEPARATORS.search(text):
            return self._ids([text])[0].tobytes()
        parts = self.PIECES.findall(text.lower()) if plain else text.split()
        new = set(parts).difference(self.known)
        if new and len(self.known) + len(new) > REMEMBERED_WORDS // 2:
            self.known, self.older = {}, self.known
            new = set(parts)
        if new:
            self.known.update((part, self.older[part]) for part in new & self.older.keys())
            if unknown := list(new.difference(self.known)):
                self._learn(unknown, plain)
        out = b"".join(map(self.known.__getitem__, parts))
        for part in new:
            if len(part) > REMEMBERED_CHARS:
                del self.known[part]
        return out


@cache
def encoder_of(tokenizer_file: str) -> WordEncoder:
    return WordEncoder(tokenizer_file)


_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])


def cut_batches(batches: Iterator[pa.RecordBatch], encode: Callable[[str], bytes], end: bytes, length: int) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, text) -> batches of pieces, each begun anew after TEXTS texts or BATCH_BYTES of ids."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECE, strict=True)], schema=_PIECE)

    for batch in batches:
        for first in range(0, batch.num_rows, TEXTS):
            some, rows, n_bytes = batch.slice(first, TEXTS), [], 0
            for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                ids = (encode(text) if text else b"") + end
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, part))
                n_bytes += len(ids)
                if n_bytes >= BATCH_BYTES:
                    yield batch_of(rows)
                    rows, n_bytes = [], 0
            if rows:
                yield batch_of(rows)


def token_pieces(docs: DataFrame, tokenizer_file: str, end_id: int = 1, length: int = SEQUENCE) -> DataFrame:
    """(doc_id, text, ..) -> doc_id, piece, start, length, ids: every document's ids and ``end_id``, cut where longer.

    ``ids`` are little-endian unsigned 32-bit numbers. NULL and empty texts have the end alone. Repeated rows stay.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter_worker("packing", encoder_of.cache_clear)
        end = np.array([end_id], dtype="<u4").tobytes()
        yield from cut_batches(batches, encoder_of(tokenizer_file).encode, end, length)
        leave_worker()

    schema = "doc_id long, piece int, start long, length long, ids binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


# -- plan --------------------------------------------------------------------------


class Slots(NamedTuple):
    """Documents of one length, of ranks first_rank up to first_rank + n, take sequences from ``sequence`` on, at ``offset``."""

    length: int
    first_rank: int
    n: int
    sequence: int
    offset: int


def best_fit_plan(histogram: dict[int, int], size: int = SEQUENCE) -> list[Slots]:
    """Best-fit-decreasing over counts: longest first, each into the fullest sequence that still holds it.

    Sequences of equal room are kept as runs (first, how many), and a run takes as many documents of a
    length as fit, so the work depends on the distinct lengths and not on the documents.
    """
    if any(not 0 < length <= size for length in histogram):
        raise ValueError(f"lengths must be 1 to {size}")
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []
    plan: list[Slots] = []
    opened = 0

    def keep(left: int, first: int, n: int) -> None:
        if left and n:
            if not room[left]:
                insort(rooms, left)
            room[left].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, todo = 0, histogram[length]

        def fill(first: int, n: int, left: int, each: int) -> None:
            nonlocal rank
            for k in range(each):
                plan.append(Slots(length, rank, n, first, size - left + k * length))  # noqa: B023
                rank += n
            keep(left - each * length, first, n)  # noqa: B023

        while todo:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, n = room[left].pop()
                if not room[left]:
                    rooms.pop(at)
            else:
                left, first = size, opened
                n = -(-todo // (size // length))
                opened += n
            each = left // length
            full = min(n, todo // each)
            if full:
                fill(first, full, left, each)
            todo -= full * each
            first, n = first + full, n - full
            if n and todo and todo < each:
                fill(first, 1, left, todo)
                todo, first, n = 0, first + 1, n - 1
            keep(left, first, n)
    return plan


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Rows with ``length`` (1 to size) -> the same rows with sequence_id and offset, in as few sequences as best-fit finds.

    Other columns pass through; doc_id and piece, if there, fix the order of ranks. No rows in, none out.
    """
    spark = pieces.sparkSession
    order = ["length", *[c for c in ("doc_id", "piece") if c in pieces.columns]]
    ranked = with_rank(pieces, *order, rank="_rank")
    histogram = {r[0]: r[1] for r in ranked.groupBy("length").count().collect()}
    before, start = {}, 0
    for length in sorted(histogram):
        before[length] = start
        start += histogram[length]
    plan = [
        (s.length, before[s.length] + s.first_rank, before[s.length] + s.first_rank + s.n, s.sequence, s.offset)
        for s in best_fit_plan(histogram, size)
    ]
    names = ["length", "_from", "_to", "_sequence", "offset"]
    slots = local_table(spark, pa.schema([(n, pa.int64()) for n in names]), plan)
    if len(plan) <= BROADCAST_PLAN_ROWS:
        slots = F.broadcast(slots)
    return (
        ranked.join(slots, "length")
        .where("_rank >= _from and _rank < _to")
        .withColumn("sequence_id", F.col("_sequence") + F.col("_rank") - F.col("_from"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def packed_documents(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Per piece its place, and the checksum of its ids; the ids themselves are neither written nor shuffled."""
    pieces = token_pieces(docs, tokenizer_file)
    digest = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    # Written first: ranking samples its input, which would encode every text twice.
    return pack(written(digest, "pieces", batch_bytes=BATCH_BYTES))
