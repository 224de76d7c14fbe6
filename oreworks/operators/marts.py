"""Gold aggregates and the read queries of the monitoring views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.spec import TableSpec

# Stage names of the funnel.
FUNNEL_STAGES = {"bronze": "Bronze (Raw)", "silver": "Silver (Cleaned)", "gold": "Gold (Aggregated)"}


def gold_by_date(silver: DataFrame, spec: TableSpec) -> DataFrame:
    """The spec's measures per date; partial aggregates leave one row per date and task to shuffle."""
    measures = [F.expr(sql).alias(name) for name, sql in spec.measures.items()]
    return silver.groupBy(spec.date_column).agg(*measures)


def gold_trend(gold: DataFrame, spec: TableSpec, measure: str = "average_age") -> DataFrame:
    """One measure over time, in date order."""
    return gold.select(spec.date_column, measure).orderBy(spec.date_column)


def layer_counts(spark: SparkSession, layers: Mapping[str, DataFrame | None]) -> DataFrame:
    """Row count per layer; an absent layer counts 0."""
    counts = [
        (spark.range(0) if df is None else df)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def layer_funnel(
    spark: SparkSession, bronze: DataFrame | None, silver: DataFrame | None, gold: DataFrame | None
) -> DataFrame:
    """(stage, rows) of the three layers."""
    layers = {"bronze": bronze, "silver": silver, "gold": gold}
    stages = {FUNNEL_STAGES[name]: df for name, df in layers.items()}
    return layer_counts(spark, stages).withColumnRenamed("layer", "stage")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts over at most ``bins`` equal-width bins between min and max of all values but NULL and NaN.

    Two scans of one column: the first yields the two bounds, the second groups
    by a bin number, so the shuffle carries at most ``bins`` rows per task.
    """
    value = F.col(column).cast("double")
    known = df.where(value.isNotNull() & ~F.isnan(value))
    low, high = known.agg(F.min(value), F.max(value)).first()
    width = (high - low) / bins if low is not None and high > low else 1.0
    start = low if low is not None else 0.0
    # The maximum belongs to the last bin, not to one of its own.
    number = F.least(F.floor((value - F.lit(start)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (
        known.groupBy(number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (F.lit(start) + F.col("bin") * F.lit(width)).alias("bin_start"),
            (F.lit(start) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
            "n",
        )
        .orderBy("bin")
    )


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of an order; planned as a per-task top-n, not a sort of the table."""
    return df.orderBy(*order).limit(n)


def latest_rows(df: DataFrame, time_column: str, tie_break: Sequence[str], n: int = 100) -> DataFrame:
    """Newest ``n`` rows. Rows of one batch share their time, hence the tie-break."""
    return top_rows(df, [F.desc(time_column), *[F.desc(c) for c in tie_break]], n)


def silver_order(spec: TableSpec) -> list[Column]:
    """Newest date first, then key; NULL keys first."""
    return [F.desc(spec.date_column), *[F.col(k).asc_nulls_first() for k in spec.key]]


def silver_page(silver: DataFrame, spec: TableSpec, n: int = 100) -> DataFrame:
    return top_rows(silver, silver_order(spec), n)
