"""The layered run: bronze, quality gate, silver, gold."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.operators.clean import dedup_by_key, derive_date, fill_nulls
from oreworks.operators.marts import gold_by_date
from oreworks.operators.monitor import log_incident, record_run
from oreworks.operators.quality import gate, metric_names, metrics_schema, quality_metrics, rule_counts
from oreworks.session import sized_shuffles
from oreworks.sources.files import read_drop, stamp
from oreworks.sources.rowlog import append_rows, one_row
from oreworks.sources.versioned import Commit, VersionedTable, check_batch_id
from oreworks.spec import Layout, TableSpec

# Names and message the incident table is searched by.
PIPELINE = "unified_pipeline"
GATE_TASK = "validation_step"
MAIN_TASK = "main_process"
GATE_MESSAGE = "Pipeline halted due to critical Data Quality issues in Bronze."

SUCCEEDED, HALTED, NO_INPUT = "succeeded", "halted", "no_input"
# Bytes a row takes in a shuffle per byte in a compressed columnar file, a cautious guess.
SHUFFLED_PER_STORED = 4
LAYER_MODES = ("overwrite", "append", "replace_partitions")


@dataclass(frozen=True)
class RunResult:
    """Outcome of one run; a caller must look at ``status``, a halt is not an error."""

    run_id: str
    status: str
    bronze_rows: int = 0
    silver_rows: int = 0
    gold_rows: int = 0
    metrics: Mapping[str, int] = field(default_factory=dict)
    duration_s: float = 0.0

    @property
    def ok(self) -> bool:
        return self.status != HALTED


def bronze_rows(raw: DataFrame, spec: TableSpec, at: datetime | Column | None = None) -> DataFrame:
    """Raw rows with their ingestion time."""
    return stamp(raw, spec.time_column, at)


def silver_rows(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key, its date, and defaults for NULL cells."""
    one = dedup_by_key(bronze, spec.key, [spec.time_column, *spec.order_by], last=[spec.file_column])
    return fill_nulls(derive_date(one, spec.time_column, spec.date_column), spec.fill)


def check_quality(
    spark: SparkSession,
    bronze: DataFrame,
    spec: TableSpec,
    layout: Layout,
    at: datetime | None = None,
    record_id: str | None = None,
) -> tuple[bool, dict[str, int]]:
    """Measure bronze, append the metrics row, and say whether the gate passes.

    The row is appended also when the gate fails; an empty table passes and
    leaves no row.
    """
    row = gate(quality_metrics(bronze, spec, at=at), spec).first()
    metrics = {name: row[name] for name in metric_names(spec)}
    if metrics["total_rows"]:
        _append_metrics(spark, spec, layout, metrics, at, record_id)
    return row["passed"], metrics


def _append_metrics(
    spark: SparkSession,
    spec: TableSpec,
    layout: Layout,
    metrics: Mapping[str, int],
    at: datetime | None,
    record_id: str | None,
) -> None:
    record = {**metrics, "validation_time": at or datetime.now(timezone.utc)}
    append_rows(one_row(spark, metrics_schema(spec), record), layout.dq_metrics, record_id, at)


def _after_failure(step: Callable[[], object]) -> None:
    """Do what is left to record of a failed run; the run's own error is the one to be raised."""
    try:
        step()
    except Exception:
        logging.getLogger(__name__).exception("could not record a failed run")


def write_layer(table: VersionedTable, df: DataFrame, mode: str, **how) -> Commit:
    if mode not in LAYER_MODES:
        raise ValueError(f"mode must be one of {LAYER_MODES}")
    return getattr(table, mode)(df, **how)


def layer_tables(spark: SparkSession, spec: TableSpec, layout: Layout) -> dict[str, VersionedTable]:
    return {
        "bronze": VersionedTable(spark, layout.bronze),
        "silver": VersionedTable(spark, layout.silver, [spec.date_column]),
        "gold": VersionedTable(spark, layout.gold, [spec.date_column]),
    }


def run_medallion(
    spark: SparkSession,
    spec: TableSpec,
    layout: Layout,
    *,
    raw: DataFrame | None = None,
    at: datetime | None = None,
    silver_mode: str = "overwrite",
    batch_id: str | None = None,
) -> RunResult:
    """Run all layers once over the input folder, or over ``raw`` rows given by a caller.

    ``at`` fixes every clock of the run. ``batch_id`` names a batch that may be
    tried again: layers it has committed are not written twice. ``silver_mode``
    is ``overwrite`` (silver holds this batch only), ``append`` or
    ``replace_partitions``; with the last two only the gold dates of this batch
    are computed again.

    Each input file is parsed once, by the bronze write; the gate and silver read
    the Parquet rows, the gate its rule columns only. The one shuffle of rows is
    silver's dedup; its partitions are sized from the bytes bronze has written.
    """
    check_batch_id(batch_id)
    started = time.monotonic()
    clock = at or datetime.now(timezone.utc)
    run_id = batch_id or f"run_{int(clock.timestamp())}"
    tables = layer_tables(spark, spec, layout)
    how = {"batch_id": batch_id, "timestamp": clock}
    try:
        if raw is None:
            raw = read_drop(spark, layout.input, spec.schema, file_column=spec.file_column)
        if raw is None or raw.isEmpty():
            return RunResult(run_id, NO_INPUT)

        # Bronze time is one constant of the batch, so it is fixed before the write.
        written = tables["bronze"].overwrite(bronze_rows(raw, spec, clock), **how)
        bronze = tables["bronze"].read_commit(written)
        # A batch tried again keeps the clock, and so the date, of its first try.
        clock = written.timestamp
        how["timestamp"] = clock
        bronze_count = written.metric("numOutputRows")

        # The gate itself needs no shuffle. Duplicates do, but when silver is written
        # they are the rows it dropped; only a halt or a failure counts them apart.
        counts = gate(rule_counts(bronze, spec), spec).first()
        if not counts["passed"]:
            _, metrics = check_quality(spark, bronze, spec, layout, clock, batch_id)
            log_incident(
                spark, layout.trace, PIPELINE, run_id, GATE_TASK, GATE_MESSAGE, "CRITICAL", at=clock, record_id=batch_id
            )
            return RunResult(run_id, HALTED, bronze_count, metrics=metrics)
        try:
            # The rows' size in memory and on their way is some times that of the compressed files.
            with sized_shuffles(spark, SHUFFLED_PER_STORED * written.metric("numOutputBytes")):
                silver = write_layer(tables["silver"], silver_rows(bronze, spec), silver_mode, **how)
        except Exception:
            _after_failure(lambda: check_quality(spark, bronze, spec, layout, clock, batch_id))
            raise
        dropped = counts["total_rows"] - silver.metric("numOutputRows")
        metrics = {n: dropped if n == spec.duplicate_metric else counts[n] for n in metric_names(spec)}
        _append_metrics(spark, spec, layout, metrics, clock, batch_id)

        current = tables["silver"].read_commit(silver)
        gold_mode = "overwrite"
        if silver_mode != "overwrite":
            # Every row of the batch carries the batch's clock, hence one date.
            current = current.where(F.col(spec.date_column) == F.to_date(F.lit(clock)))
            gold_mode = "replace_partitions"
        gold = write_layer(tables["gold"], gold_by_date(current, spec), gold_mode, **how)

        duration = time.monotonic() - started
        record_run(spark, layout.run_metrics, clock.timestamp(), duration, batch_id)
        return RunResult(
            run_id,
            SUCCEEDED,
            bronze_count,
            silver.metric("numOutputRows"),
            gold.metric("numOutputRows"),
            metrics,
            duration,
        )
    except Exception as error:
        text = str(error)
        _after_failure(
            lambda: log_incident(spark, layout.trace, PIPELINE, run_id, MAIN_TASK, text, at=clock, record_id=batch_id)
        )
        raise
