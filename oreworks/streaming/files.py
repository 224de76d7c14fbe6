"""File-drop streams: whatever arrives in the input folder is taken once, by Structured Streaming.

A file stream knows files by path alone, so each arrival first moves to a path of its own in the landing folder: the
time of landing, its modification time, its length and its name. A file that comes again under a used name is therefore a new
arrival. From there two file sources, one per format, are read as one stream; the checkpoint holds which files belong to which batch,
and a batch that died is run again over the same files. The age of a file does not matter.

Writers put whole files into the input folder (by renaming them, say). Queries with checkpoints of their own share the landing folder.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.plans.medallion import bronze_rows, run_medallion
from oreworks.sources.listing import files_in, make_folder, place_file
from oreworks.sources.versioned import VersionedTable
from oreworks.spec import Layout, TableSpec

# Spark forgets files older than this, compared with the newest one it has seen, and would pass over such arrivals.
OLDEST = "36500d"
# Files a batch takes from each of the two sources at most; a longer backlog takes more batches.
BATCH_FILES = 10_000


def land_arrivals(spark: SparkSession, layout: Layout) -> int:
    """Move each CSV and JSON file of the input folder to its place in the landing folder; returns their number.

    Each move is one rename, so a caller that dies leaves every file in one of the two folders. Empty files stay, as they may be still to be
    written.
    """
    make_folder(spark, layout.landing)
    arrived = [f for f in files_in(spark, layout.input) if f.length and f.name.endswith((".csv", ".json"))]
    for file in arrived:
        name = f"{time.time_ns() // 1_000_000}_{file.modified_ms}_{file.length}_{file.name}"
        place_file(spark, f"{layout.input}/{file.name}", f"{layout.landing}/{name}")
    return len(arrived)


def stream_arrivals(
    spark: SparkSession, spec: TableSpec, layout: Layout, *, archive: bool = False, max_files: int | None = None
) -> DataFrame:
    """The landed files as one stream, each row with the path its file arrived under."""

    def source(pattern: str):
        reader = (
            spark.readStream.schema(spec.schema)
            .option("pathGlobFilter", pattern)
            .option("maxFileAge", OLDEST)
            .option("maxFilesPerTrigger", max_files or BATCH_FILES)
        )
        if archive:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", layout.archive)
        return reader

    csv = source("*.csv").option("header", True).option("enforceSchema", False).csv(layout.landing)
    json = source("*.json").json(layout.landing)
    landed = rf"{re.escape(layout.landing.rpartition('/')[2])}/\d+_\d+_\d+_([^/]*)$"
    arrived = F.regexp_replace("_metadata.file_path", landed, f"{layout.input.rpartition('/')[2]}/$1")
    return csv.select("*", arrived.alias(spec.file_column)).unionByName(json.select("*", arrived.alias(spec.file_column)))


def _take(
    spark: SparkSession,
    spec: TableSpec,
    layout: Layout,
    each: Callable[[DataFrame, str], object],
    *,
    name: str,
    every: float | None,
    **source,
) -> int:
    """Run ``each`` over all batches; returns their number. With ``every`` files land and batches run every so many seconds, for ever."""
    done, errors = [], []

    def named(batch: DataFrame, number: int) -> None:
        # The query's id lives in its checkpoint: the same over restarts, another one for a new
        # checkpoint, whose batches start from 0 again and must not pass for old ones.
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        try:
            each(batch, f"{name}_{query_id}_{number}")
        except Exception as error:
            errors.append(error)
            raise
        done.append(number)

    land_arrivals(spark, layout)
    writer = stream_arrivals(spark, spec, layout, **source).writeStream.queryName(name).foreachBatch(named)
    writer = writer.option("checkpointLocation", layout.checkpoint(name))
    query = writer.trigger(**({"processingTime": f"{every} seconds"} if every is not None else {"availableNow": True})).start()
    try:
        if every is None:
            query.awaitTermination()
        else:
            while not query.awaitTermination(every):
                land_arrivals(spark, layout)
    except StreamingQueryException:
        if errors:
            raise errors[0]  # the caller's own error, not the report of the query it stopped
        raise
    finally:
        query.stop()
    return len(done)


def ingest_arrivals(
    spark: SparkSession,
    spec: TableSpec,
    layout: Layout,
    *,
    name: str = "ingest",
    every: float | None = None,
    archive: bool = False,
    max_files: int | None = None,
) -> int:
    """Append every arriving row to bronze, once. A batch tried again finds its own commit.

    ``archive`` has Spark move the files of a finished batch away when a later batch is planned. ``max_files`` bounds what a batch takes
    of each format, so a backlog is worked off in batches of a known size.
    """

    def each(batch: DataFrame, batch_id: str) -> None:
        VersionedTable(batch.sparkSession, layout.bronze).append(bronze_rows(batch, spec), batch_id=batch_id)

    return _take(spark, spec, layout, each, name=name, every=every, archive=archive, max_files=max_files)


def medallion_arrivals(
    spark: SparkSession,
    spec: TableSpec,
    layout: Layout,
    *,
    name: str = "medallion",
    every: float | None = None,
    archive: bool = False,
    max_files: int | None = None,
    silver_mode: str = "overwrite",
    on_result: Callable | None = None,
) -> int:
    """Run all layers for each batch of arriving files.

    A batch the gate halts counts as taken, its incident is logged; an error is logged and raised, and the next
    call tries the batch again. ``on_result`` receives each batch's RunResult.
    """

    def each(batch: DataFrame, batch_id: str) -> None:
        result = run_medallion(batch.sparkSession, spec, layout, raw=batch, silver_mode=silver_mode, batch_id=batch_id)
        if on_result:
            on_result(result)

    return _take(spark, spec, layout, each, name=name, every=every, archive=archive, max_files=max_files)
