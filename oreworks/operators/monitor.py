"""Incidents, run times and the views over a table's history."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.functions.text import failure_message, metric_number, thousands, timestamp_text, two_decimals
from oreworks.sources.rowlog import append_rows, one_row, read_rows

INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField("dag_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("epoch_s", T.DoubleType()),
        T.StructField("duration_s", T.DoubleType()),
    ]
)


def log_incident(
    spark: SparkSession,
    path: str,
    dag_id: str,
    run_id: str,
    task_id: str,
    message: str,
    status: str = "ERROR",
    *,
    at: datetime | None = None,
    record_id: str | None = None,
) -> None:
    """Append one incident; the session stays the caller's."""
    row = {
        "dag_id": dag_id,
        "run_id": run_id,
        "task_id": task_id,
        "message": message,
        "status": status,
        "timestamp": at or datetime.now(timezone.utc),
    }
    append_rows(one_row(spark, INCIDENT_SCHEMA, row), path, record_id, row["timestamp"])


def failure_incidents(failures: DataFrame, status: str = "ERROR") -> DataFrame:
    """Failed tasks (dag_id, run_id, task_id, exception, timestamp) as incident rows."""
    return failures.select(
        "dag_id",
        "run_id",
        F.coalesce("task_id", F.lit("DAG")).alias("task_id"),
        failure_message(F.coalesce("task_id", F.lit("DAG")), F.col("exception")).alias("message"),
        F.lit(status).alias("status"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    )


def read_incidents(spark: SparkSession, path: str) -> DataFrame | None:
    return read_rows(spark, path, INCIDENT_SCHEMA)


def record_run(
    spark: SparkSession, path: str, epoch_s: float, duration_s: float, record_id: str | None = None
) -> None:
    """Append the duration of one finished run, to two decimals."""
    row = {"epoch_s": float(epoch_s), "duration_s": round(float(duration_s), 2)}
    finished = datetime.fromtimestamp(epoch_s, timezone.utc)
    append_rows(one_row(spark, RUN_SCHEMA, row), path, record_id, finished)


def run_kpis(spark: SparkSession, runs: DataFrame | None, silver: DataFrame | None) -> DataFrame:
    """One row: last run's duration as text (``0.00`` without runs), silver rows as number and text."""
    runs = spark.createDataFrame([], RUN_SCHEMA) if runs is None else runs
    silver = spark.range(0) if silver is None else silver
    last = runs.agg(F.max_by("duration_s", F.struct("epoch_s", "duration_s")).alias("duration_s"))
    rows = silver.agg(F.count(F.lit(1)).alias("n"))
    # Two one-row aggregates side by side: a union summed up, no join needed.
    both = last.unionByName(rows, allowMissingColumns=True)
    return both.agg(
        two_decimals(F.coalesce(F.max("duration_s"), F.lit(0.0))).alias("last_run"),
        F.sum("n").alias("silver_rows"),
        thousands(F.sum("n")).alias("silver_rows_text"),
    )


def history_report(history: DataFrame, more: Mapping[str, str] | None = None) -> DataFrame:
    """Rows and bytes written per version, newest first; operations without a metric show 0.

    ``more`` adds further metrics, by column name.
    """
    metrics = {"rows_written": "numOutputRows", "output_bytes": "numOutputBytes", **(more or {})}
    return history.select(
        "version",
        timestamp_text(F.col("timestamp")).alias("timestamp"),
        "operation",
        *[metric_number(F.col("operation_metrics"), metric).alias(name) for name, metric in metrics.items()],
    ).orderBy(F.desc("version"))


def history_volume(history: DataFrame) -> DataFrame:
    """Rows written over time, only operations that wrote some."""
    report = history_report(history).select("version", "timestamp", "rows_written")
    return report.where("rows_written > 0").orderBy("timestamp", "version").select("timestamp", "rows_written")
