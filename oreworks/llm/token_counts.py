"""Token counts by heap-and-linked-list byte-pair merging.

A piece of text starts as one symbol per byte. The adjacent pair of lowest merge rank is
popped, joined in the linked list, and its new neighbours are pushed. The
count is the initial symbols minus the merges; no identifiers are made.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm.common import enter_worker

# Fixed value: the pattern that splits text before byte-level merges.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Bounds of a worker's memory of counted pieces; what is forgotten is counted anew.
REMEMBERED_PIECES = 400_000
REMEMBERED_CHARS = 48


def byte_letters() -> dict[int, str]:
    """Byte -> the printable letter that stands for it in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairCounter:
    """Counts tokens of text for one byte-level merge list and its special strings."""

    def __init__(self, merges: list[tuple[str, str]], specials: list[str]):
        symbols: dict[str, int] = {}
        number = lambda s: symbols.setdefault(s, len(symbols))
        self.of_byte = [number(letter) for _, letter in sorted(byte_letters().items())]
        # (left, right) -> (rank, joined symbol)
        self.joined: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            self.joined.setdefault((number(a), number(b)), (rank, number(a + b)))
        self.pieces = regex.compile(PIECES)
        longest_first = sorted(specials, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, longest_first))) if specials else None
        self.known: dict[str, int] = {}

    def merged(self, data: bytes) -> int:
        """Symbols left of one piece."""
        left_of = len(data)
        if left_of < 2:
            return left_of
        joined = self.joined
        symbol = [self.of_byte[b] for b in data]
        after = list(range(1, left_of + 1))
        before = list(range(-1, left_of - 1))
        heap = []
        for i, pair in enumerate(pairwise(symbol)):
            if found := joined.get(pair):
                heap.append((found[0], i, pair, found[1]))
        heapify(heap)
        n, count = left_of, left_of
        while heap:
            _, i, pair, new = heappop(heap)
            j = after[i]
            # Stale if either side has changed or gone since the pair was pushed.
            if symbol[i] != pair[0] or j >= n or symbol[j] != pair[1]:
                continue
            symbol[i], symbol[j] = new, -1
            k = after[i] = after[j]
            count -= 1
            if k < n:
                before[k] = i
                if found := joined.get((new, symbol[k])):
                    heappush(heap, (found[0], i, (new, symbol[k]), found[1]))
            h = before[i]
            if h >= 0 and (found := joined.get((symbol[h], new))):
                heappush(heap, (found[0], h, (symbol[h], new), found[1]))
        return count

    def _piece(self, piece: str) -> int:
        n = self.merged(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= REMEMBERED_CHARS:
            if len(self.known) >= REMEMBERED_PIECES:
                self.known.clear()
            self.known[piece] = n
        return n

    def _plain(self, text: str) -> int:
        total, known = 0, self.known
        for piece in self.pieces.findall(text):
            n = known.get(piece)
            total += self._piece(piece) if n is None else n
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.specials is None:
            return self._plain(text)
        parts = self.specials.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


@cache
def counter_of(tokenizer_file: str) -> PairCounter:
    """Of a tokenizers file with byte-level merges; read once per worker."""
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    return PairCounter(merges, [t["content"] for t in spec["added_tokens"]])


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int) -> DataFrame:
    """(doc_id, text, ..) -> doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit), one row per row of docs.

    NULL and empty texts count 0. A special string inside a text is one token, as the library has it by default.
    ``tokenizer_file`` must exist on every executor.
    """

    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enter_worker("token_counts", counter_of.cache_clear)
        counter = counter_of(tokenizer_file)
        for batch in texts:
            yield pd.Series([counter.count(t) for t in batch], dtype="int64")

    count = F.pandas_udf(counted, "long")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), count("text").alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
