"""Quality metrics in one pass, and the gate over them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.spec import TableSpec


def metric_names(spec: TableSpec) -> list[str]:
    return ["total_rows", *[r.metric for r in spec.rules], spec.duplicate_metric]


def metrics_schema(spec: TableSpec) -> T.StructType:
    """Schema of the metrics table."""
    return T.StructType(
        [
            *[T.StructField(name, T.LongType()) for name in metric_names(spec)],
            T.StructField("validation_time", T.TimestampType()),
        ]
    )


def quality_metrics(
    df: DataFrame, spec: TableSpec, *, by: Sequence[str] = (), at: datetime | Column | None = None
) -> DataFrame:
    """Row count, violations per rule and duplicate keys, as one row (or one per ``by`` group).

    Duplicates are rows minus distinct keys, NULL being one key value. One scan
    of the rule and key columns: first counters per key, then their sums. The
    partial aggregate in front of the shuffle cuts a hot key to one row per task.
    """
    totals = ["total_rows", *[r.metric for r in spec.rules]]
    per_key = df.groupBy(*by, *spec.key).agg(*_counters(spec))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals]
    duplicates = F.coalesce(F.sum("total_rows"), F.lit(0)) - F.count(F.lit(1))
    when = F.current_timestamp() if at is None else at if isinstance(at, Column) else F.lit(at)
    return (
        per_key.groupBy(*by).agg(*sums, duplicates.alias(spec.duplicate_metric)).withColumn("validation_time", when)
    )


def rule_counts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Row count and violations per rule only: all the gate needs, and no shuffle of rows."""
    return df.agg(*_counters(spec))


def _counters(spec: TableSpec) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.expr(r.condition)).alias(r.metric) for r in spec.rules],
    ]


def gate(metrics: DataFrame, spec: TableSpec) -> DataFrame:
    """Add ``<metric>_ratio`` per blocking rule and ``passed`` to metrics or rule counts.

    A rule blocks when its ratio is strictly above its bound, so a ratio equal
    to the bound passes. A table without rows passes.
    """
    blocking = [r for r in spec.rules if r.max_ratio is not None]
    for r in blocking:
        metrics = metrics.withColumn(f"{r.metric}_ratio", F.try_divide(F.col(r.metric), F.col("total_rows")))
    passed = F.lit(True)
    for r in blocking:
        passed = passed & (F.coalesce(F.col(f"{r.metric}_ratio"), F.lit(0.0)) <= r.max_ratio)
    return metrics.withColumn("passed", passed)


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """The newest metrics row; of several of one time, the one of the highest numbers."""
    rest = [c for c in metrics.columns if c != "validation_time"]
    return metrics.orderBy(F.desc("validation_time"), *[F.desc(c) for c in rest]).limit(1)


def violation_breakdown(metrics: DataFrame, spec: TableSpec) -> DataFrame:
    """Metrics columns as (violation, count) rows, under the rules' labels."""
    labels = {r.metric: r.label for r in spec.rules} | {spec.duplicate_metric: spec.duplicate_label}
    labelled = metrics.select(*[F.col(metric).alias(label) for metric, label in labels.items()])
    return labelled.unpivot([], [f"`{label}`" for label in labels.values()], "violation", "violations")
