"""SimHash made of built-in functions: hashed terms vote on 64 signed bits; only counters are shuffled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64
# Sixteen 64-bit sums hold four 16-bit counters each. A chunk of terms is so long
# that no counter of it overflows: CHUNK x largest weight < 2^15.
LANES = 0x0001000100010001
CHUNK = 1 << 13
MAX_WEIGHT = 3


def hex_text(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def differing_bits(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def positions(n_words: Column, span: int) -> Column:
    """First words of the runs of ``span`` words: one run for a shorter text, none (NULL) for no word."""
    last = F.greatest(n_words - span, F.lit(0))
    return F.when(n_words > 0, F.sequence(F.lit(0), last))


def run_text(words: Column, at: Column, span: int) -> Column:
    """``span`` words from ``at`` on, space-joined; fewer at the end of a short text."""
    return F.concat_ws(" ", *[F.get(words, at + k) for k in range(span)])


def vote(terms: DataFrame, key: list[str], hashed: Column, weight: Column | None = None) -> DataFrame:
    """Rows (key.., at: place of the term or NULL, ..) -> key.., fingerprint.

    A bit is 1 if terms of over half the weight have it set. Keys whose only
    row has a NULL ``at`` have no terms and get 0. Rows are summed before the
    shuffle, one row of sixteen longs per key and chunk leaves a task.
    """
    w = F.lit(1) if weight is None else weight
    w = F.when(F.col("at").isNotNull(), w).cast("long")
    h = terms.withColumns({"_h": hashed, "_w": w, "_chunk": F.floor(F.col("at") / CHUNK)})
    lanes = [
        F.sum(F.shiftrightunsigned("_h", c).bitwiseAND(F.lit(LANES)) * F.col("_w")).alias(f"_l{c}") for c in range(16)
    ]
    chunks = h.groupBy(*key, "_chunk").agg(F.sum("_w").alias("_n"), *lanes)
    wide = F.lit(0x0000FFFF0000FFFF)
    sums = [F.sum("_n").alias("_n")]
    for c in range(16):
        sums += [
            F.sum(F.col(f"_l{c}").bitwiseAND(wide)).alias(f"_even{c}"),
            F.sum(F.shiftrightunsigned(f"_l{c}", 16).bitwiseAND(wide)).alias(f"_odd{c}"),
        ]
    totals = chunks.groupBy(*key).agg(*sums)
    low = lambda name: F.col(name).bitwiseAND(F.lit(0xFFFFFFFF))
    high = lambda name: F.shiftrightunsigned(name, 32)
    bits = []
    for c in range(16):
        for k, count in enumerate((low(f"_even{c}"), low(f"_odd{c}"), high(f"_even{c}"), high(f"_odd{c}"))):
            bit = c + 16 * k
            value = (1 << bit) if bit < 63 else -(1 << 63)
            bits.append(F.when(count * 2 > F.col("_n"), F.lit(value)).otherwise(F.lit(0).cast("long")))
    return totals.select(*key, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fingerprint"))
