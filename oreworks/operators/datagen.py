"""Repeatable test-data generators: people rows with NULL ages and three kinds of duplicates.

Each takes a frame with a unique ``id`` column (``spark.range(1, n + 1)``, or the key of
any table) and draws names and ages from a hash of the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.functions.draws import chance, draw

# Names and age range of the generated people.
NAMES = ["Alice", "Bob", "Charlie", "David", "Eve", "Frank", "Grace", "Heidi", "Ivan", "Judy"]
MIN_AGE, MAX_AGE = 18, 80

# Draws are 32 bits wide; their upper 16 bits give 65,536 equal rank ranges.
_RANGE_SHIFT = 16


def _people(ids: DataFrame, null_age_rate: float, seed: int) -> DataFrame:
    key = F.col("id")
    names = F.array(*[F.lit(n) for n in NAMES])
    age = F.lit(MIN_AGE) + F.pmod(draw(key, "age", seed), F.lit(MAX_AGE - MIN_AGE + 1))
    return ids.select(
        key.cast("int").alias("id"),
        F.element_at(names, (F.lit(1) + F.pmod(draw(key, "name", seed), F.lit(len(NAMES)))).cast("int")).alias("name"),
        F.when(~chance(key, "null_age", seed, null_age_rate), age.cast("int")).alias("age"),
    )


def _shuffled(df: DataFrame, seed: int, copy: Column) -> DataFrame:
    """Rows in a repeatable random order, so that copies do not sit together."""
    place = draw(F.concat(F.col("id").cast("string"), F.lit("/"), copy.cast("string")), "place", seed)
    return df.orderBy(place, "id").select("id", "name", "age")


def sample_exactly(df: DataFrame, k: int, rank: Column) -> DataFrame:
    """``k`` rows with the smallest ``rank`` (a draw) of all, or every row if there are fewer.

    A plain ``orderBy.limit(k)`` gathers k rows in one task. Instead the counts of 65,536
    rank ranges tell which ranges are taken whole; only the range at the cut is sorted.
    """
    ranked = df.withColumn("_rank", rank)
    bucket = F.shiftright("_rank", _RANGE_SHIFT).alias("_bucket")
    whole, left = -1, k
    # At most 65,536 rows: one per rank range.
    for row in ranked.groupBy(bucket).count().orderBy("_bucket").collect():
        if row["count"] > left:
            break
        whole, left = row["_bucket"], left - row["count"]
    else:
        return df
    cut = row["_bucket"]
    taken = ranked.where(bucket <= whole)
    rest = ranked.where(bucket == cut).orderBy("_rank", *df.columns).limit(left)
    return taken.unionByName(rest).drop("_rank")


def people_with_sampled_duplicates(ids: DataFrame, null_age_rate: float, k: int, seed: int = 1) -> DataFrame:
    """One row per id plus ``k`` of these rows again, in random order."""
    rows = _people(ids, null_age_rate, seed)
    again = sample_exactly(rows, k, draw(F.col("id"), "sample", seed))
    both = rows.withColumn("copy", F.lit(1)).unionByName(again.withColumn("copy", F.lit(2)))
    return _shuffled(both, seed, F.col("copy"))


def people_with_inline_duplicates(
    ids: DataFrame, null_age_rate: float, duplicate_rate: float = 0.05, seed: int = 1
) -> DataFrame:
    """One row per id, each repeated right behind itself with probability ``duplicate_rate``."""
    copies = F.when(chance(F.col("id"), "repeat", seed, duplicate_rate), 2).otherwise(1)
    return (
        _people(ids, null_age_rate, seed)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .select("id", "name", "age")
    )


def people_with_reused_ids(ids: DataFrame, null_age_rate: float, reuse: int, seed: int = 1) -> DataFrame:
    """One row per id, then the ids up to ``reuse`` again under a newly drawn name and age."""
    again = _people(ids.where(F.col("id") <= reuse), 0.0, seed + 1)
    return _people(ids, null_age_rate, seed).unionByName(again)
