"""What several text operators share: written tables, distributed ranks, connected components, bounded samples."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.session import work_dir
from oreworks.sources.listing import delete_path

_ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, _ASCII_UPPER, _ASCII_UPPER.lower())


# Spark's setting to remove the shuffle files of a query when it has ended.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Spark's setting for the bytes of a batch that goes to a Python worker.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Bytes of a batch of texts, on either side of a worker's pipe.
BATCH_BYTES = 4 << 20


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Inside, the session has these settings; after, it is as it was."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def written(df: DataFrame, purpose: str, bucket_by: str | None = None, batch_bytes: int | None = None) -> DataFrame:
    """The rows as a table in the shared folder: computed once, cut from their lineage, safe from lost executors.

    The shuffle files behind it go when it is written, not when the driver happens to collect its garbage. A table
    bucketed by a column, in as many buckets as there are shuffle partitions, is joined on it without being shuffled.
    ``batch_bytes`` bounds the batches that go to Python workers, for texts of any length.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, purpose)
    settings = {_DROP_SHUFFLES: "true"} | ({_BATCH_BYTES: str(batch_bytes)} if batch_bytes else {})
    with _set(spark, settings):
        if bucket_by is None:
            df.write.parquet(path)
        else:
            name = f"{purpose}_{uuid.uuid4().hex}"
            buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
            df.write.format("parquet").option("path", path).bucketBy(buckets, bucket_by).sortBy(bucket_by).saveAsTable(name)
    table = spark.read.schema(df.schema).parquet(path) if bucket_by is None else spark.table(name)
    _folders[table] = path
    if bucket_by is not None:
        _names[table] = name
    return table


_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
# Names of those that are bucketed.
_names: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def released(*tables: DataFrame) -> None:
    """Delete written tables that no later query reads; others go when the driver ends."""
    for table in tables:
        if table in _names:
            table.sparkSession.sql(f"drop table if exists {_names.pop(table)}")
        delete_path(table.sparkSession, _folders.pop(table))


# What operators' tasks remember in this Python worker, with a way to forget it.
_remembered: dict[str, Callable[[], object]] = {}


def enter_worker(operator: str, forget: Callable[[], object] | None = None) -> None:
    """To be called as a task begins: what other operators remember in a reused worker goes, and freed memory goes back to the system.

    ``forget`` drops what this operator remembers from task to task.
    """
    for other in [k for k in _remembered if k != operator]:
        _remembered.pop(other)()
    if forget:
        _remembered[operator] = forget
    leave_worker()


def leave_worker() -> None:
    """To be called as a task ends, after it has let go of its data: a worker that waits for its next task holds no freed memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def crc_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod``; NULL ids have no remainder."""
    return F.crc32(doc_id.cast("string").cast("binary")) % mod


def local_table(spark: SparkSession, schema: pa.Schema, rows: list[tuple]) -> DataFrame:
    """Rows that the driver holds as a table. Sent as Arrow, so that no Python worker starts on the executors to pass them on."""
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))


_OFFSETS = pa.schema([("_part", pa.int32()), ("_start", pa.int64())])


def with_rank(df: DataFrame, *order: str, rank: str = "rank") -> DataFrame:
    """Gapless ranks from 0 in the given order, which should leave no ties.

    Range partitions are sorted and written with their place in the partition;
    offsets are the running counts of the partitions, of which there are as many
    as shuffle partitions. No task sees more than its own partition.
    """
    spark = df.sparkSession
    placed = written(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_seq")),
        "rank",
    )
    placed = placed.withColumn("_seq", F.col("_seq").bitwiseAND((1 << 33) - 1))
    offsets, start = [], 0
    for part, n in sorted(tuple(r) for r in placed.groupBy("_part").count().collect()):
        offsets.append((part, start))
        start += n
    table = local_table(spark, _OFFSETS, offsets)
    return (
        placed.join(F.broadcast(table), "_part")
        .withColumn(rank, F.col("_start") + F.col("_seq"))
        .drop("_part", "_seq", "_start")
    )


def running_total(df: DataFrame, order: list[str], amount: str, total: str) -> DataFrame:
    """Adds ``total``: the sum of ``amount`` (long) up to and with each row in the given order, which should leave no ties.

    df should be written, as ranges are sampled from it. Each task adds up its own range; the totals of the ranges, of which there are as
    many as shuffle partitions, become offsets. No task sees more than its own range, whatever the order's leading column holds.
    """
    spark = df.sparkSession

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, so_far = TaskContext.get().partitionId(), 0
        for batch in batches:
            sums = np.cumsum(batch.column(amount).to_numpy(zero_copy_only=False), dtype=np.int64) + so_far
            so_far = int(sums[-1]) if len(sums) else so_far
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(sums), part, np.int32)), pa.array(sums)],
                [*batch.schema.names, "_part", "_sum"],
            )

    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_sum", T.LongType())])
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(added, schema), "running")
    offsets, start = [], 0
    for part, n in sorted(tuple(r) for r in placed.groupBy("_part").agg(F.max("_sum")).collect()):
        offsets.append((part, start))
        start += n
    table = spark.createDataFrame(offsets, "_part int, _start long")
    return placed.join(F.broadcast(table), "_part").withColumn(total, F.col("_start") + F.col("_sum")).drop("_part", "_sum", "_start")


def _smallest(pairs: DataFrame) -> DataFrame:
    """Per u the smallest of u and its v."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(
        edges.select(F.col("dst").alias("u"), F.col("src").alias("v"))
    )
    linked = both.join(_smallest(both), "u").where("v > u")
    return linked.select(F.col("v").alias("src"), F.col("m").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    low = _smallest(down)
    others = down.join(low, "u").where("v <> m").select(F.col("v").alias("src"), F.col("m").alias("dst"))
    return others.unionByName(low.select(F.col("u").alias("src"), F.col("m").alias("dst"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(src, dst) of long nodes -> (node, root): every linked node but the roots, with its component's smallest node.

    Alternating large and small stars (Kiveris et al., 2014): each round moves
    neighbours to the smallest known one, so the number of rounds grows with the
    logarithm of the component, edges never multiply, and each round is written.
    """
    edges = written(edges.where("src <> dst").select("src", "dst").distinct(), "links")
    state = _state(edges)
    while state[0]:
        before, edges = edges, written(_small_star(_large_star(edges)), "stars")
        released(before)
        last, state = state, _state(edges)
        if last == state:
            break
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))


def labelled_sample(labels: DataFrame, label: str, folds: int, held_out: int, bound: int) -> DataFrame:
    """At most ``bound`` (doc_id, y) outside the held-out fold, the smallest id hashes first; both values needed.

    Repeated labels of a document count once, as their highest value.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    usable = usable.where(crc_remainder(F.col("doc_id"), folds) != held_out)
    return (
        usable.groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
