"""Mixture-controlled packing: deficit round-robin over source queues.

In every round, which is one sequence, each queue gets its share of the sequence as credit and serves the tokens its credit
pays for; what is left stays as deficit for the next round. Documents may be cut anywhere, so tokens are served one by one, each when the queue's
credit reaches it, and a queue drops out only when it is empty. What a queue has served after t tokens of output is then known without
running through them (``shares``). Each partition therefore starts with the deficits that its predecessors leave and need not
wait for them, and token ids never cross the network: a partition's place in its queues follows from the token counts of those before it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import accumulate
from math import lcm
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.byte_tokens import byte_encoder, text_slices
from oreworks.llm.common import enter_worker, running_total, written

SEQUENCE = 1024
# A source has a queue of its own if its share of a sequence is so many tokens at least; the others share one queue, document by
# document in the order of partition and source. So there are at most SEQUENCE / LEAST_SLICE + 1 queues.
LEAST_SLICE = 16
# A row of the encoded table holds so many tokens at most; a longer document takes several rows.
ROW_TOKENS = 4096
# (partition, source) pairs whose places in their queues are broadcast (about 50 bytes each); more are joined by shuffle.
BROADCAST_PLACES = 500_000
# Edges of sequences whose state a worker remembers.
REMEMBERED_EDGES = 4096
# Rows cut at once, a bound of a worker's memory.
ROWS_AT_ONCE = 512
# The key of rows without a source; that of a source begins with an equals sign.
NO_SOURCE = "none"


# -- plan --------------------------------------------------------------------------


def shares(weights: list[int], t: int) -> list[int]:
    """How many of the first t tokens each queue serves: its j-th token is due at (j + 1/2) / weight, ties go to the first queue.

    The shares never shrink as t grows, sum up to t, and stay near t x weight / total.
    """
    total = sum(weights)
    out = [(2 * t * w + total) // (2 * total) for w in weights]
    late = t - sum(out)
    while late > 0:
        k = None
        for q, w in enumerate(weights):
            if w and (k is None or (2 * out[q] + 1) * weights[k] < (2 * out[k] + 1) * w):
                k = q
        out[k] += 1
        late -= 1
    while late < 0:
        k = None
        for q, w in enumerate(weights):
            if out[q] and (k is None or (2 * out[q] - 1) * weights[k] >= (2 * out[k] - 1) * w):
                k = q
        out[k] -= 1
        late += 1
    return out


class Phase(NamedTuple):
    """From output token ``start`` on the queues serve by ``weights``, after the ``taken`` of earlier phases."""

    start: int
    taken: list[int]
    weights: list[int]


class RoundRobin:
    """Which tokens of which queue make up which sequence.

    tokens: of each queue. weights: target of each queue, in any unit; a queue of weight 0 is served when all others are empty,
    by its tokens. Without weights all queues are served by their tokens, and so end together. A phase ends when a queue is empty.
    """

    def __init__(self, tokens: list[int], weights: list[Fraction] | None = None, size: int = SEQUENCE):
        self.tokens, self.size, self.total = tokens, size, sum(tokens)
        self.phases: list[Phase] = []
        self.known: dict[int, tuple[list[int], list[int]]] = {}
        taken, start = [0] * len(tokens), 0
        while start < self.total:
            left = [n - t for n, t in zip(tokens, taken, strict=True)]
            wanted = [Fraction(w) if n else Fraction(0) for w, n in zip(weights or left, left, strict=True)]
            if not any(wanted):
                wanted = [Fraction(n) for n in left]
            unit = lcm(*[w.denominator for w in wanted])
            phase = Phase(start, taken, [int(w * unit) for w in wanted])
            self.phases.append(phase)
            if phase.weights == left:
                break
            # The first queue to end, by the time its last token is due, and what all have served by then.
            end = min(Fraction(2 * n - 1, 2 * w) for n, w in zip(left, phase.weights, strict=True) if w)
            served = [int(end * w + Fraction(1, 2)) for w in phase.weights]
            taken = [t + n for t, n in zip(taken, served, strict=True)]
            start += sum(served)
        self.starts = [p.start for p in self.phases]
        # What is left after the whole sequences is cut at powers of two, so that no sequence needs padding.
        self.whole = self.total // size
        self.tail = [self.whole * size]
        while self.tail[-1] < self.total:
            self.tail.append(self.tail[-1] + (1 << (self.total - self.tail[-1]).bit_length() - 1))

    def served(self, t: int) -> tuple[list[int], list[int]]:
        """Per queue the tokens it has served after t tokens of output, and those of the queues before it."""
        found = self.known.get(t)
        if found is None:
            phase = self.phases[bisect_right(self.starts, t) - 1]
            own = [n + m for n, m in zip(phase.taken, shares(phase.weights, t - phase.start), strict=True)]
            if len(self.known) >= REMEMBERED_EDGES:
                self.known.clear()
            found = self.known[t] = own, [0, *accumulate(own)]
        return found

    def edge(self, sequence: int) -> int:
        return sequence * self.size if sequence <= self.whole else self.tail[sequence - self.whole]

    def sequence_at(self, t: int) -> int:
        return t // self.size if t < self.tail[0] else self.whole + bisect_right(self.tail, t) - 1

    def sequence_of(self, queue: int, token: int) -> int:
        """The sequence that holds a queue's token."""
        phase = self.phases[max(0, bisect_right(self.phases, token, key=lambda p: p.taken[queue]) - 1)]
        weight = phase.weights[queue] or 1
        due = phase.start + (2 * (token - phase.taken[queue]) + 1) * sum(phase.weights) // (2 * weight)
        near = self.sequence_at(min(due, self.total - 1))
        while near and self.served(self.edge(near))[0][queue] > token:
            near -= 1
        while self.served(self.edge(near + 1))[0][queue] <= token:
            near += 1
        return near

    def slices(self, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per row the tokens first up to first + n of a queue -> row, length, sequence, offset of its slices, in order.

        Inside a sequence the queues follow each other.
        """
        spans = [(self.sequence_of(q, a), self.sequence_of(q, a + k - 1)) for q, a, k in zip(queue.tolist(), first.tolist(), n.tolist(), strict=True)]
        # A queue served less than once in four sequences is asked for token by token.
        tried = [
            np.arange(a, b + 1) if b - a < 4 * k else np.unique([self.sequence_of(q, t) for t in range(f, f + k)])
            for (a, b), q, f, k in zip(spans, queue.tolist(), first.tolist(), n.tolist(), strict=True)
        ]
        row = np.repeat(np.arange(len(n)), [len(x) for x in tried])
        sequence = np.concatenate(tried)
        edges = np.unique(np.concatenate([sequence, sequence + 1]))
        state = [self.served(self.edge(s)) for s in edges.tolist()]
        own, ahead = np.array([x for x, _ in state], np.int64), np.array([x for _, x in state], np.int64)
        since, until = np.searchsorted(edges, sequence), np.searchsorted(edges, sequence + 1)
        q = queue[row]
        begin, end = np.maximum(own[since, q], first[row]), np.minimum(own[until, q], (first + n)[row])
        offset = ahead[until, q] - ahead[since, q] + begin - own[since, q]
        some = end > begin
        return row[some], (end - begin)[some], sequence[some], offset[some]


# -- token ids ---------------------------------------------------------------------


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(NO_SOURCE))


def encoded_rows(docs: DataFrame, tokenizer_file: str, end_id: int) -> DataFrame:
    """(doc_id, text, source, ..) -> part, source, before, doc_id, doc_tokens, start, n, ids: at most ROW_TOKENS tokens a row.

    before: tokens of that source that the same task has met earlier. ids are little-endian, two bytes each where the vocabulary allows. Written, so every text is encoded once.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter_worker("mixture", byte_encoder.cache_clear)
        encoder, part = byte_encoder(tokenizer_file), TaskContext.get().partitionId()
        before: dict[str, int] = defaultdict(int)
        for batch in batches:
            for some in text_slices(batch, "text"):
                ids, ends = encoder.encode(some.column("text"), end_id)
                per_doc = np.diff(ends, prepend=0)
                rows = -(-per_doc // ROW_TOKENS)
                doc = np.repeat(np.arange(len(rows)), rows)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(rows) - rows, rows)) * ROW_TOKENS
                n = np.minimum(per_doc[doc] - start, ROW_TOKENS)
                sources = some.column("source").take(pa.array(doc))
                places = []
                for source, k in zip(sources.to_pylist(), n.tolist(), strict=True):
                    places.append(before[source])
                    before[source] += k
                stored = ids.astype("<u2" if encoder.n_ids <= 1 << 16 else "<u4")
                limits = np.concatenate([[0], np.cumsum(n) * stored.itemsize]).astype(np.int32)
                data = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(limits), pa.py_buffer(stored.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), part, np.int32)),
                        sources,
                        pa.array(places, pa.int64()),
                        some.column("doc_id").take(pa.array(doc)),
                        pa.array(per_doc[doc]),
                        pa.array(start),
                        pa.array(n),
                        data,
                    ],
                    ["part", "source", "before", "doc_id", "doc_tokens", "start", "n", "ids"],
                )

    schema = "part int, source string, before long, doc_id long, doc_tokens long, start long, n long, ids binary"
    plain = docs.select(F.col("doc_id").cast("long"), source_key(F.col("source")).alias("source"), "text")
    return written(plain.mapInArrow(encoded, schema), "mixture_tokens")


# -- packing -----------------------------------------------------------------------


def _queues(rows: DataFrame, targets: Mapping[str | None, float] | None, size: int, least: int) -> tuple[list[str], RoundRobin]:
    """Source keys with a queue of their own, by name, and the plan; the last queue is that of all other sources."""
    by_source = written(rows.groupBy("source").agg(F.sum("n").alias("n")), "mixture_sources")
    total = by_source.agg(F.sum("n")).first()[0] or 0
    own = F.col("n") * size >= least * total
    weights = {NO_SOURCE if s is None else f"={s}": Fraction(w) for s, w in (targets or {}).items()}
    if weights:
        own = F.col("source").isin(list(weights))
    names = {r.source: r.n for r in by_source.where(own).collect()}
    queues = sorted(names)
    tokens = [names[q] for q in queues]
    tokens.append(total - sum(tokens))
    return queues, RoundRobin(tokens, [*[weights[q] for q in queues], Fraction(0)] if weights else None, size)


def mixed_sequences(
    docs: DataFrame,
    tokenizer_file: str,
    *,
    end_id: int = 0,
    targets: Mapping[str | None, float] | None = None,
    size: int = SEQUENCE,
    least: int = LEAST_SLICE,
) -> DataFrame:
    """(doc_id, text, source, ..) -> doc_id, start, length, ids, doc_tokens, sequence_id, offset, source: one row per piece of a document.

    Every sequence holds each queue's share of tokens, to about a token. ``targets`` are wished shares by source, in any unit; a source that runs
    out leaves its share to the others, and sources not named come last. Without targets the shares are those of the
    corpus itself, so that every sequence is a sample of the whole mixture and no queue runs out before the end. ids are little-endian unsigned 32-bit numbers.

    NULL and empty texts have the end alone, NULL sources are a source, NULL ids stay rows, repeated rows stay, and other columns are passed over. A very long
    text is encoded in one piece and stored in rows of ROW_TOKENS. All sequences are full but the last few, whose lengths are powers of two. No rows in, none out.
    """
    rows = encoded_rows(docs, tokenizer_file, end_id)
    queues, plan = _queues(rows, targets, size, least)
    number = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for q, k in zip(queues, range(len(queues))) for x in (q, k)]), F.col("source")), F.lit(len(queues))) if queues else F.lit(0)
    counts = rows.groupBy("part", "source").agg(F.sum("n").alias("n")).withColumn("queue", number)
    places = running_total(written(counts, "mixture_counts"), ["queue", "part", "source"], "n", "upto")
    firsts = [0, *accumulate(plan.tokens)]
    first = F.element_at(F.array(*[F.lit(x).cast("long") for x in firsts]), F.col("queue") + 1)
    places = places.select("part", "source", "queue", (F.col("upto") - F.col("n") - first).alias("place"))
    if places.count() <= BROADCAST_PLACES:
        places = F.broadcast(places)
    wide = (rows.join(places, ["part", "source"])).select(
        "queue", (F.col("place") + F.col("before")).alias("place"), "source", "doc_id", "doc_tokens", "start", "n", "ids"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                queue, place, start, n = (some.column(c).to_numpy() for c in ("queue", "place", "start", "n"))
                row, length, sequence, offset = plan.slices(queue, place, n)
                # A row's slices are its tokens in order, so one buffer holds the ids of all.
                upto = np.cumsum(length)
                inside = upto - length - (np.cumsum(n) - n)[row]
                ids = [np.frombuffer(x, "<u2" if len(x) == 2 * k else "<u4") for x, k in zip(some.column("ids").to_pylist(), n.tolist(), strict=True)]
                data = np.concatenate(ids).astype("<u4").tobytes()
                limits = np.concatenate([[0], 4 * upto]).astype(np.int32)
                who = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id").take(who),
                        pa.array(start[row] + inside),
                        pa.array(length),
                        pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(limits), pa.py_buffer(data)]),
                        some.column("doc_tokens").take(who),
                        pa.array(sequence),
                        pa.array(offset),
                        some.column("source").take(who),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "source"],
                )

    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, source string"
    pieces = wide.mapInArrow(cut, schema)
    return pieces.withColumn("source", F.when(F.col("source") != NO_SOURCE, F.expr("substring(source, 2)")))


def mixture_digest(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Per piece its place, and the checksum in place of the ids."""
    pieces = mixed_sequences(docs, tokenizer_file).withColumn("ids_crc32", F.crc32("ids"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")
