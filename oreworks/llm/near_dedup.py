"""SimHash near-duplicates by anchor-point covering.

Fingerprints that differ in at most three of 64 bits differ in at most one bit of
one of their halves. The anchors of a half are the words of a covering code: the
perfect binary Golay code (23 bits, covering radius 3) times the perfect Hamming code
(7 bits, radius 1) times two plain bits (radius 0), 2^18 anchors. A fingerprint has one
home, its nearest anchor, and is copied to every anchor within a block's radius plus
the threshold of one bit, about ten. Two fingerprints that agree in a half but for
one bit therefore meet at the home of either. Each anchor compares homes with
copies; whole fingerprints decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreworks.llm.common import ascii_lower, connected_components, written
from oreworks.llm.simhash import differing_bits, hex_text, positions, run_text, vote

THRESHOLD = 3
SHINGLE = 3
WORD_GAPS = r"[\x20\x09-\x0D]+"

# Generator polynomials of the perfect Golay and Hamming codes.
GOLAY = (23, 3, 0b101011100011)
HAMMING = (7, 1, 0b1011)


# -- fingerprints ------------------------------------------------------------------


def shingle_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ..) -> (doc_id, fingerprint) per row: three-word shingles, repeats included, XXH64 with seed 42.

    A text of fewer words is one shingle; NULL, empty and blank texts get 0.
    Repeated ids stay separate rows.
    """
    words = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.array_remove(F.split(ascii_lower(F.coalesce("text", F.lit(""))), WORD_GAPS), "").alias("words"),
    )
    terms = words.select("row", "doc_id", "words", F.explode_outer(positions(F.size("words"), SHINGLE)).alias("at"))
    # Spark's xxhash64 is XXH64 of the UTF-8 bytes with seed 42.
    hashed = F.xxhash64(run_text(F.col("words"), F.col("at"), SHINGLE))
    return vote(terms, ["row", "doc_id"], hashed).drop("row")


# -- anchors -----------------------------------------------------------------------


@cache
def _code(n: int, radius: int, generator: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of a perfect cyclic code: the syndrome of each n-bit word, and per syndrome the patterns to anchors.

    The first pattern leads to the nearest anchor (at most ``radius`` bits), the others to the anchors one bit beyond.
    """
    high = generator.bit_length() - 1
    of_bit = np.empty(n, dtype=np.int64)
    for bit in range(n):
        rest = 1 << bit
        for k in range(bit, high - 1, -1):
            if rest >> k & 1:
                rest ^= generator << (k - high)
        of_bit[bit] = rest
    patterns: list[list[int]] = [[] for _ in range(1 << high)]
    for size in range(radius + 2):
        for bits in combinations(range(n), size):
            at = int(np.bitwise_xor.reduce(of_bit[list(bits)])) if bits else 0
            patterns[at].append(sum(1 << b for b in bits))
    return of_bit, [np.array(p, dtype=np.int64) for p in patterns]


def _syndromes(values: np.ndarray, of_bit: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), dtype=np.int64)
    for bit, s in enumerate(of_bit):
        out ^= np.where(values >> bit & 1, s, 0)
    return out


def _block_anchors(values: np.ndarray, code: tuple[int, int, int]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Home anchors, and per value the anchors just beyond the covering radius."""
    of_bit, patterns = _code(*code)
    found = _syndromes(values, of_bit)
    home = values ^ np.array([p[0] for p in patterns], dtype=np.int64)[found]
    return home, [v ^ patterns[s][1:] for v, s in zip(values, found, strict=True)]


def anchors_of(fingerprints: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Signed 64-bit fingerprints -> (n, 2) homes and, per fingerprint, all anchors it is copied to, homes included.

    An anchor carries its half in bit 40.
    """
    bits = fingerprints.astype(np.int64).view(np.uint64)
    homes, copies = [], []
    for half in range(2):
        part = (bits >> np.uint64(32 * half) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        golay, far_golay = _block_anchors(part & 0x7FFFFF, GOLAY)
        hamming, far_hamming = _block_anchors(part >> 23 & 0x7F, HAMMING)
        plain = part >> 30
        tag = half << 40
        home = tag | plain << 30 | hamming << 23 | golay
        homes.append(home)
        copies.append(
            [
                np.concatenate(
                    [
                        [home[i]],
                        tag | plain[i] << 30 | hamming[i] << 23 | far_golay[i],
                        tag | plain[i] << 30 | far_hamming[i] << 23 | golay[i],
                        home[i] ^ np.array([1 << 30, 1 << 31]),
                    ]
                )
                for i in range(len(part))
            ]
        )
    return np.stack(homes, axis=1), [np.concatenate(c) for c in zip(*copies, strict=True)]


def _placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        values = batch["fingerprint"].to_numpy()
        if not len(values):
            continue
        homes, copies = anchors_of(values)
        sizes = [len(c) for c in copies]
        at = np.concatenate(copies)
        who = np.repeat(values, sizes)
        home = np.repeat(homes, sizes, axis=0)
        yield pd.DataFrame({"anchor": at, "fingerprint": who, "home": (at == home[:, 0]) | (at == home[:, 1])})


def near_pairs(fingerprints: DataFrame) -> DataFrame:
    """Distinct fingerprints -> pairs (src < dst) of at most THRESHOLD differing bits, each once."""
    placed = written(
        fingerprints.select("fingerprint").mapInPandas(_placed, "anchor long, fingerprint long, home boolean"), "anchors"
    )
    homes = placed.where("home").select("anchor", F.col("fingerprint").alias("src"))
    copies = placed.select("anchor", F.col("fingerprint").alias("dst"))
    near = homes.join(copies, "anchor").where(
        (F.col("src") < F.col("dst")) & (differing_bits(F.col("src"), F.col("dst")) <= THRESHOLD)
    )
    return near.select("src", "dst").distinct()


# -- groups ------------------------------------------------------------------------


def near_duplicate_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ..) -> (doc_id, fingerprint string, component_id), one row per row of docs.

    component_id is the smallest doc_id reachable by links of at most three bits.
    Equal fingerprints meet as one node, so copies are never paired. Texts
    without words share the fingerprint 0 and are linked like any others. A NULL id stays
    a row and does not name a component; a component of NULL ids has a NULL name.
    """
    prints = written(shingle_fingerprints(docs), "fingerprints")
    nodes = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "nodes")
    roots = connected_components(near_pairs(nodes)).withColumnRenamed("node", "fingerprint")
    rooted = nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(names, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", hex_text(F.col("fingerprint")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The rows of docs without near-duplicates: of each group the row of the smallest id stays.

    groups: (doc_id, component_id) of docs, those of near_duplicate_groups if not given.
    Of repeated rows of that id one stays, the smallest by the hash of its text. Rows without an
    id cannot be told apart from each other's groups and all stay.
    """
    groups = near_duplicate_groups(docs) if groups is None else groups
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi")
    copies = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    once = kept.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy")
    return once.unionByName(docs.where("doc_id is null"))
