"""Every operator as a runnable query over the given tables.

The ``events`` table plays the raw drop: ids with NULLs and repeats, ages with
NULLs and out-of-range values, two source files, all derived by rule. Queries
that need files or table versions write the whole derived table below the shared
work folder and read it back. Dates and times leave as text, so that any engine
can compare them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.functions.text import percent, run_id
from oreworks.operators import clean, datagen, export, marts, monitor, profile, quality
from oreworks.plans import medallion
from oreworks.session import work_dir
from oreworks.sources import files
from oreworks.sources.listing import files_in, place_file
from oreworks.sources.rowlog import append_rows, merge_closed_months, read_newest_month
from oreworks.sources.versioned import VersionedTable
from oreworks.spec import PEOPLE, Layout
from oreworks.streaming.files import ingest_arrivals, medallion_arrivals

# Derived rows carry their event id, which orders rows of one time.
SPEC = replace(PEOPLE, order_by=("event_id",))
CLOCK = datetime(2024, 2, 1, 12, 0, tzinfo=timezone.utc)
PEOPLE_COLUMNS = ["id", "name", "age"]
UPDATE_WHERE, UPDATE_SET = "id BETWEEN 100 AND 140", {"age": "age * 2"}
DELETE_WHERE = "age < 3 OR name = 'error'"


# -- derived inputs ----------------------------------------------------------------


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as people rows with faults."""
    event = F.col("event_id")
    key = F.when(event % 37 == 0, None).when(event % 11 == 0, event - 1).otherwise(event)
    age = F.when(event % 10 != 0, F.floor("value").cast("int") - 10)
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        key.cast("int").alias("id"),
        F.col("event_type").alias("name"),
        age.alias("age"),
        F.col("ts").alias("ingestion_time"),
        F.when(event % 2 == 0, "a.csv").otherwise("b.json").alias("source_file"),
        "event_id",
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.silver_rows(raw_rows(spark, sf_dir), SPEC)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.gold_by_date(silver(spark, sf_dir), SPEC)


def _even(df: DataFrame) -> DataFrame:
    return df.where("event_id % 2 = 0")


def _odd(df: DataFrame) -> DataFrame:
    return df.where("event_id % 2 = 1")


def _show(df: DataFrame, *columns: str) -> DataFrame:
    """Selected columns, dates and times as text."""
    formats = {T.DateType: "yyyy-MM-dd", T.TimestampType: "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    formats[T.TimestampNTZType] = formats[T.TimestampType]
    picked = df.select(*columns) if columns else df
    return picked.select(
        *[
            F.date_format(f.name, formats[type(f.dataType)]).alias(f.name) if type(f.dataType) in formats else f.name
            for f in picked.schema.fields
        ]
    )


def _drop_files(spark: SparkSession, sf_dir: str, purpose: str) -> Layout:
    """A fresh base whose input folder holds the even rows as CSV and the odd rows as JSON files."""
    layout = Layout(work_dir(spark, purpose))
    rows = raw_rows(spark, sf_dir)
    _even(rows).select(*PEOPLE_COLUMNS).write.option("header", True).mode("append").csv(layout.input)
    _odd(rows).select(*PEOPLE_COLUMNS).write.mode("append").json(layout.input)
    return layout


def _layers(spark: SparkSession, sf_dir: str, purpose: str) -> dict[str, VersionedTable]:
    """Bronze, silver and gold written as tables from the derived rows."""
    tables = medallion.layer_tables(spark, SPEC, Layout(work_dir(spark, purpose)))
    tables["bronze"].overwrite(raw_rows(spark, sf_dir))
    tables["silver"].overwrite(medallion.silver_rows(tables["bronze"].read(), SPEC), rebalance=True)
    tables["gold"].overwrite(marts.gold_by_date(tables["silver"].read(), SPEC))
    return tables


def _four_versions(spark: SparkSession, sf_dir: str, purpose: str) -> VersionedTable:
    """Overwrite, append, update and delete, one second apart."""
    rows = clean.derive_date(raw_rows(spark, sf_dir), "ingestion_time", "processed_date")
    rows = rows.select(*PEOPLE_COLUMNS, "event_id", "processed_date")
    table = VersionedTable(spark, work_dir(spark, purpose), ["processed_date"])
    second = timedelta(seconds=1)
    table.overwrite(_even(rows), timestamp=CLOCK)
    table.append(_odd(rows), timestamp=CLOCK + second)
    table.update(UPDATE_WHERE, UPDATE_SET, timestamp=CLOCK + 2 * second)
    table.delete(DELETE_WHERE, timestamp=CLOCK + 3 * second)
    return table


# -- sources and sinks -------------------------------------------------------------


def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "ingest_csv")
    raw_rows(spark, sf_dir).select(*PEOPLE_COLUMNS).write.option("header", True).csv(folder)
    return files.read_csv(spark, f"{folder}/*.csv", PEOPLE.schema)


def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "ingest_json")
    raw_rows(spark, sf_dir).select(*PEOPLE_COLUMNS).write.json(folder)
    return files.read_json(spark, f"{folder}/*.json", PEOPLE.schema)


def ingest_optional_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder has CSV files only; the JSON source is skipped."""
    folder = work_dir(spark, "ingest_optional")
    raw_rows(spark, sf_dir).select(*PEOPLE_COLUMNS).write.option("header", True).csv(folder)
    return files.read_drop(spark, folder, PEOPLE.schema).select(*PEOPLE_COLUMNS)


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _drop_files(spark, sf_dir, "union_sources")
    return files.read_drop(spark, layout.input, PEOPLE.schema).select(*PEOPLE_COLUMNS)


def _bronze(spark: SparkSession, sf_dir: str, purpose: str) -> DataFrame:
    layout = _drop_files(spark, sf_dir, purpose)
    raw = files.read_drop(spark, layout.input, PEOPLE.schema)
    table = VersionedTable(spark, layout.bronze)
    table.overwrite(medallion.bronze_rows(raw, PEOPLE, CLOCK))
    kind = F.regexp_extract("source_file", r"\.(csv|json)$", 1).alias("file_kind")
    return table.read().select("*", kind)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(_bronze(spark, sf_dir, "bronze"), *PEOPLE_COLUMNS, "ingestion_time", "file_kind")


def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct ingestion times per kind of source file."""
    return (
        _bronze(spark, sf_dir, "bronze_lineage")
        .groupBy("file_kind")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("ingestion_time").alias("n_times"))
    )


def read_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = VersionedTable(spark, work_dir(spark, "read_layer"))
    table.overwrite(raw_rows(spark, sf_dir))
    return _show(table.read())


def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = VersionedTable(spark, work_dir(spark, "write_overwrite"))
    table.overwrite(_even(raw_rows(spark, sf_dir)))
    table.overwrite(_odd(raw_rows(spark, sf_dir)))
    return _show(table.read())


def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = VersionedTable(spark, work_dir(spark, "write_append"))
    table.append(_even(raw_rows(spark, sf_dir)))
    table.append(_odd(raw_rows(spark, sf_dir)))
    return _show(table.read())


def schema_evolution_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_rows(spark, sf_dir).select("event_id", *PEOPLE_COLUMNS)
    table = VersionedTable(spark, work_dir(spark, "schema_evolution"))
    table.append(_even(rows))
    table.append(_odd(rows).withColumn("x", F.lit(1)))
    return table.read()


def partitioned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = VersionedTable(spark, work_dir(spark, "partitioned_read"), ["processed_date"])
    table.overwrite(silver(spark, sf_dir), rebalance=True)
    one_day = table.read().where(F.col("processed_date") == F.lit("2024-01-15").cast("date"))
    return _show(one_day, *PEOPLE_COLUMNS, "processed_date")


def csv_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "csv_export")
    rows = silver(spark, sf_dir).select(*PEOPLE_COLUMNS, "processed_date")
    export.export_csv(rows, folder, marts.silver_order(SPEC))
    return _show(files.read_csv(spark, folder, rows.schema))


# -- cleaning ----------------------------------------------------------------------


def _types(df: DataFrame, **columns: str) -> DataFrame:
    """The types of columns as further columns, since times leave as text."""
    return df.withColumns({name: F.lit(dict(df.dtypes)[c].removesuffix("_ntz")) for name, c in columns.items()})


def silver_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(_types(silver(spark, sf_dir), time_type="ingestion_time", date_type="processed_date"))


def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.dedup_by_key(raw_rows(spark, sf_dir), ["id"], ["ingestion_time", "event_id"])
    return _show(rows)


def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.fill_nulls(raw_rows(spark, sf_dir), SPEC.fill).select("event_id", *PEOPLE_COLUMNS)


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.distinct_rows(raw_rows(spark, sf_dir), PEOPLE_COLUMNS)


# -- quality -----------------------------------------------------------------------


def _metrics(spark: SparkSession, sf_dir: str, *by: str) -> DataFrame:
    return quality.quality_metrics(raw_rows(spark, sf_dir), SPEC, by=by, at=CLOCK)


def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir).drop("validation_time")


def dq_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, "source_file").drop("validation_time")


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = quality.gate(_metrics(spark, sf_dir), SPEC)
    return gated.select(
        "total_rows",
        "null_ids",
        F.round("null_ids_ratio", 9).alias("null_ids_ratio"),
        percent(F.col("null_ids_ratio")).alias("null_ids_percent"),
        "passed",
    )


def dq_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violation_breakdown(_metrics(spark, sf_dir), SPEC)


def dq_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two metrics rows are appended, of the CSV rows and later of all rows; the later one is shown."""
    path = work_dir(spark, "dq_latest")
    rows = raw_rows(spark, sf_dir)
    schema = quality.metrics_schema(SPEC)
    for rows_in, at in ((_even(rows), CLOCK), (rows, CLOCK + timedelta(hours=1))):
        append_rows(quality.quality_metrics(rows_in, SPEC, at=at), path, at=at)
    merge_closed_months(spark, path, schema)
    return _show(quality.latest_metrics(read_newest_month(spark, path, schema)))


# -- marts and views ---------------------------------------------------------------


def gold_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(_types(gold(spark, sf_dir), date_type="processed_date"))


def gold_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(marts.gold_trend(gold(spark, sf_dir), SPEC))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _layers(spark, sf_dir, "layer_counts")
    return marts.layer_counts(spark, {name: table.read() for name, table in tables.items()})


def layer_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _layers(spark, sf_dir, "layer_funnel")
    return marts.layer_funnel(spark, **{name: table.read() for name, table in tables.items()})


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.histogram(raw_rows(spark, sf_dir), "age", 20).select(
        "bin", F.round("bin_start", 6).alias("bin_start"), F.round("bin_end", 6).alias("bin_end"), "n"
    )


def latest_rows_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(marts.latest_rows(raw_rows(spark, sf_dir), "ingestion_time", ["event_id"], 100))


def silver_ordered_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(marts.silver_page(silver(spark, sf_dir), SPEC, 100), *PEOPLE_COLUMNS, "processed_date")


def run_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event counts as one finished run that took ``value`` seconds."""
    path = work_dir(spark, "run_kpis")
    runs = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").cast("double").alias("epoch_s"), F.col("value").alias("duration_s")
    )
    append_rows(runs, path)
    return monitor.run_kpis(spark, read_newest_month(spark, path, monitor.RUN_SCHEMA), silver(spark, sf_dir))


# -- versions ----------------------------------------------------------------------


def _silver_table(spark: SparkSession, sf_dir: str, purpose: str) -> VersionedTable:
    table = VersionedTable(spark, work_dir(spark, purpose), ["processed_date"])
    table.overwrite(silver(spark, sf_dir), rebalance=True)
    return table


def update_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _silver_table(spark, sf_dir, "update_where")
    table.update(UPDATE_WHERE, UPDATE_SET)
    return _show(table.read(), *PEOPLE_COLUMNS, "processed_date")


def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _silver_table(spark, sf_dir, "delete_where")
    table.delete(DELETE_WHERE)
    return _show(table.read(), *PEOPLE_COLUMNS, "processed_date")


def replace_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions by a time that differs in microseconds, or is NULL, and a text that paths must escape."""
    event = F.col("event_id")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        "value",
        F.when(event % 4 != 0, F.timestamp_micros(F.lit(1704067200000000) + event % 3)).alias("slot"),
        F.when(event % 2 == 0, "a/b=c d%\"\u00e9").otherwise("plain").alias("kind"),
    )
    table = VersionedTable(spark, work_dir(spark, "replace_partitions"), ["slot", "kind"])
    table.overwrite(rows)
    table.replace_partitions(rows.where("event_id % 3 = 1 and event_id % 2 = 0").withColumn("value", F.col("value") + 1000))
    return _show(table.read())


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits = _four_versions(spark, sf_dir, "history").history()
    more = {"updated_rows": "numUpdatedRows", "deleted_rows": "numDeletedRows", "copied_rows": "numCopiedRows"}
    return monitor.history_report(commits, more).drop("output_bytes")


def history_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.history_volume(_four_versions(spark, sf_dir, "history_volume").history())


def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and age sum of every version."""
    table = _four_versions(spark, sf_dir, "table_versions")
    return reduce(
        DataFrame.unionByName,
        [
            table.read(version=v)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("age").alias("age_sum"))
            .select(F.lit(v).alias("version"), "n_rows", "age_sum")
            for v in range(4)
        ],
    )


def read_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was between its first two commits."""
    table = _four_versions(spark, sf_dir, "read_as_of")
    return _show(table.read(as_of=CLOCK + timedelta(milliseconds=500)))


# -- monitoring --------------------------------------------------------------------


def incident_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every error event is a failed task."""
    path = work_dir(spark, "incident_log")
    failures = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .where("event_type = 'error'")
        .select(
            F.lit("events").alias("dag_id"),
            run_id(F.col("ts").cast("timestamp")).alias("run_id"),
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("task_id"),
            F.repeat("props", F.lit(40)).alias("exception"),
            F.col("ts").alias("timestamp"),
        )
    )
    append_rows(monitor.failure_incidents(failures), path)
    return _show(monitor.read_incidents(spark, path))


def file_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_rows(raw_rows(spark, sf_dir), ["source_file"], PEOPLE_COLUMNS)


def file_profile_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of CSV files of a thousand events each, every seventh of which is written twice and every fifth has a line break in its name."""
    folder = work_dir(spark, "file_profile_csv")
    broken = F.when(F.col("event_id") % 5 == 0, F.concat("name", F.lit("\n,b"))).otherwise(F.col("name"))
    rows = raw_rows(spark, sf_dir).withColumn("name", broken)
    twice = rows.unionByName(rows.where("event_id % 7 = 0")).withColumn("part", F.expr("event_id div 1000"))
    twice.select(*PEOPLE_COLUMNS, "part").repartition("part").write.partitionBy("part").option("header", True).csv(folder)
    return profile.profile_csv_files(spark, folder).select(
        F.regexp_extract("file_path", r"/part=(\d+)/", 1).cast("bigint").alias("part"),
        "n_rows",
        "size_bytes",
        "duplicate_rows",
        "empty_cells",
        F.regexp_extract("profile_name", "^(s.*)_part-", 1).alias("name_start"),
    )


# -- whole runs --------------------------------------------------------------------


def medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over CSV and JSON files: the gold rows beside the run's counters."""
    layout = _drop_files(spark, sf_dir, "medallion_run")
    result = medallion.run_medallion(spark, PEOPLE, layout, at=CLOCK)
    gold_rows = medallion.layer_tables(spark, PEOPLE, layout)["gold"].read()
    counters = {
        "bronze_rows": result.bronze_rows,
        "silver_rows": result.silver_rows,
        "gold_rows": result.gold_rows,
        **{name: n for name, n in result.metrics.items() if name != "total_rows"},
    }
    return _show(
        gold_rows.select(
            F.lit(result.run_id).alias("run_id"),
            F.lit(result.status).alias("status"),
            *[F.lit(n).cast("bigint").alias(name) for name, n in counters.items()],
            "processed_date",
            "average_age",
            "total_users",
        )
    )


# A modification time long past: the age of a file must not matter.
OLD_FILE_MS = 1_000_000_000_000


def _arrive(spark: SparkSession, rows: DataFrame, layout: Layout) -> None:
    """Drop the even rows as CSV and the odd ones as JSON, under the same names each time and as old files."""
    stage = work_dir(spark, "stage")
    _even(rows).select(*PEOPLE_COLUMNS).write.option("header", True).csv(f"{stage}/csv")
    _odd(rows).select(*PEOPLE_COLUMNS).write.json(f"{stage}/json")
    for kind in ("csv", "json"):
        # A task without rows may leave an empty file, which would stay in the input folder and take the name from the next arrival.
        parts = [f.name for f in files_in(spark, f"{stage}/{kind}") if f.length and f.name.startswith("part-")]
        for i, name in enumerate(parts):
            place_file(spark, f"{stage}/{kind}/{name}", f"{layout.input}/raw_data_{i}.{kind}", OLD_FILE_MS)


def _two_arrivals(spark: SparkSession, sf_dir: str, purpose: str, take: Callable[[Layout], object]) -> Layout:
    """Two halves of the rows arrive one after the other under the same file names; the first is to be archived by then."""
    layout = Layout(work_dir(spark, purpose))
    rows = raw_rows(spark, sf_dir)
    for half in (rows.where("event_id % 4 < 2"), rows.where("event_id % 4 >= 2")):
        _arrive(spark, half, layout)
        take(layout)
    return layout


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _two_arrivals(
        spark, sf_dir, "stream_ingest", lambda to: ingest_arrivals(spark, PEOPLE, to, archive=True)
    )
    return VersionedTable(spark, layout.bronze).read().select(*PEOPLE_COLUMNS)


def stream_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver keeps what earlier batches left; each batch is deduplicated by itself."""
    layout = _two_arrivals(
        spark, sf_dir, "stream_medallion", lambda to: medallion_arrivals(spark, PEOPLE, to, archive=True, silver_mode="append")
    )
    return VersionedTable(spark, layout.silver).read().select(*PEOPLE_COLUMNS)


# -- generators, seeded by the customer keys ----------------------------------------


def _customer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("id"))


def generate_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _customer_ids(spark, sf_dir)
    return datagen.people_with_sampled_duplicates(ids, 0.2, ids.count() // 5)


def generate_people_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datagen.people_with_inline_duplicates(_customer_ids(spark, sf_dir), 0.1, 0.05)


def generate_people_reused(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _customer_ids(spark, sf_dir)
    return datagen.people_with_reused_ids(ids, 0.05, ids.count() // 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_csv": ingest_csv,
    "ingest_json": ingest_json,
    "ingest_optional_sources": ingest_optional_sources,
    "union_sources": union_sources,
    "bronze": bronze,
    "bronze_lineage": bronze_lineage,
    "read_layer": read_layer,
    "write_overwrite": write_overwrite,
    "write_append": write_append,
    "schema_evolution_append": schema_evolution_append,
    "partitioned_read": partitioned_read,
    "csv_export_roundtrip": csv_export_roundtrip,
    "silver": silver_layer,
    "dedup_by_key": dedup_by_key,
    "fill_nulls": fill_nulls,
    "distinct_rows": distinct_rows,
    "dq_metrics": dq_metrics,
    "dq_by_source": dq_by_source,
    "dq_gate": dq_gate,
    "dq_breakdown": dq_breakdown,
    "dq_latest": dq_latest,
    "gold": gold_layer,
    "gold_trend": gold_trend,
    "layer_counts": layer_counts,
    "layer_funnel": layer_funnel,
    "histogram": histogram,
    "latest_rows_topk": latest_rows_topk,
    "silver_ordered_page": silver_ordered_page,
    "run_kpis": run_kpis,
    "update_where": update_where,
    "delete_where": delete_where,
    "replace_partitions": replace_partitions,
    "history": history,
    "history_volume": history_volume,
    "table_versions": table_versions,
    "read_as_of": read_as_of,
    "incident_log": incident_log,
    "file_profile": file_profile,
    "file_profile_csv": file_profile_csv,
    "medallion_run": medallion_run,
    "stream_ingest": stream_ingest,
    "stream_medallion": stream_medallion,
    "generate_people": generate_people,
    "generate_people_inline": generate_people_inline,
    "generate_people_reused": generate_people_reused,
}
