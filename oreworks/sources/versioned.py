"""Versioned Parquet tables addressed by path.

Layout of one table::

    <path>/data/commit_version=<N>/...   rows written by commit N, Hive-partitioned below
    <path>/commits/commit=<N>/           the one row of commit N

Rows are written first and the commit row second, and readers only open the
versions the latest commit names, so a write that died half-way is never seen;
the next writer replaces it. A table has one writer at a time.

A commit states its whole table: the directories ``base_version..version``, the
schema, the partitions each version replaced (``replaced``, a partition under the last
version that did), and the last batch of each writer (``batches``). So reading and
writing open the latest commit only, however many there are. A commit row grows with the partitions that
were replaced since the last overwrite, at most all of the table's, never with rows or
versions; ``compact`` makes it small again. The read itself is one Parquet scan with a filter on
partition columns, so replaced directories are pruned while planning and no file
footer is opened for the schema.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.sources.listing import folder_names, list_files, path_exists
from oreworks.sources.rowlog import one_row

_VERSION = "commit_version"

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("base_version", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("operation_parameters", T.MapType(T.StringType(), T.StringType())),
        T.StructField("operation_metrics", T.MapType(T.StringType(), T.StringType())),
        T.StructField("batches", T.MapType(T.StringType(), T.LongType())),
        T.StructField("table_schema", T.StringType()),
        T.StructField("partition_by", T.ArrayType(T.StringType())),
        T.StructField("replaced", T.MapType(T.LongType(), T.ArrayType(T.StringType()))),
    ]
)


@dataclass(frozen=True)
class Commit:
    """One row of the commit table."""

    version: int
    base_version: int
    timestamp: datetime
    operation: str
    operation_parameters: Mapping[str, str]
    operation_metrics: Mapping[str, str]
    batches: Mapping[str, int]
    table_schema: str
    partition_by: Sequence[str]
    replaced: Mapping[int, Sequence[str]]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.table_schema))

    def metric(self, name: str) -> int:
        return int(self.operation_metrics.get(name, 0))


def merge_schemas(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Additive evolution: old columns first, new ones behind; a changed type is an error."""
    merged = {f.name: f.dataType for f in old.fields} if old else {}
    for f in new.fields:
        known = merged.setdefault(f.name, f.dataType)
        if known != f.dataType:
            raise ValueError(f"column {f.name} is {known.simpleString()}, cannot write {f.dataType.simpleString()}")
    return T.StructType([T.StructField(name, kind, True) for name, kind in merged.items()])


class VersionedTable:
    """Snapshot and append versions of one table, with update, delete and as-of reads."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = tuple(partition_by)
        self._known = -1  # newest version this object has seen

    # -- commits -----------------------------------------------------------------

    def commits(self) -> DataFrame | None:
        """The commit table, or None when the table does not exist."""
        return self._commit_rows(f"{self.path}/commits") if self._oldest() is not None else None

    def _oldest(self) -> int | None:
        """The first version that is still there; older commits may have been cleaned away."""
        if path_exists(self.spark, self._commit_path(0)):
            return 0
        names = folder_names(self.spark, f"{self.path}/commits")
        return min((int(n.partition("=")[2]) for n in names if n.startswith("commit=")), default=None)

    def commit_at(self, version: int | None = None, as_of: datetime | None = None) -> Commit | None:
        """The latest commit, the one of a version number, or the latest one up to a time."""
        if as_of is not None:
            rows = self.commits()
            return None if rows is None else _newest(rows.where(F.col("timestamp") <= F.lit(as_of)))
        if version is not None:
            return _newest(self._commit_rows(self._commit_path(version))) if self._has_commit(version) else None
        return self._latest()

    def _latest(self) -> Commit | None:
        """Find the highest version by looking at a few paths, without listing them all.

        Versions have no gaps, so doubling steps upward and then halving between
        the last version that is there and the first that is not will find it.
        """
        oldest = self._oldest()
        if oldest is None:
            return None
        there, step = max(self._known, oldest), 1
        while self._has_commit(there + step):
            there += step
            step *= 2
        missing = there + step
        while missing - there > 1:
            middle = (there + missing) // 2
            if self._has_commit(middle):
                there = middle
            else:
                missing = middle
        # Only the topmost path can lack its row, when its writer died at this point.
        for version in (there, there - 1):
            commit = self.commit_at(version) if version >= oldest else None
            if commit:
                self._known = commit.version
                return commit
        return None

    def _commit_path(self, version: int) -> str:
        return f"{self.path}/commits/commit={version}"

    def _commit_rows(self, path: str) -> DataFrame:
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(path).select(*COMMIT_SCHEMA.names)

    def _has_commit(self, version: int) -> bool:
        return path_exists(self.spark, self._commit_path(version))

    def exists(self) -> bool:
        return self.commit_at() is not None

    def history(self) -> DataFrame | None:
        """Version, time, operation, parameters and metrics; newest first."""
        commits = self.commits()
        if commits is None:
            return None
        return commits.select(
            "version", "timestamp", "operation", "operation_parameters", "operation_metrics"
        ).orderBy(F.desc("version"))

    # -- reads -------------------------------------------------------------------

    def read(self, version: int | None = None, as_of: datetime | None = None) -> DataFrame | None:
        """The table now, at ``version``, or as of a time; None when there is no such state."""
        commit = self.commit_at(version, as_of)
        return None if commit is None else self.read_commit(commit)

    def read_commit(self, commit: Commit) -> DataFrame:
        """The table as a commit in hand left it."""
        return self._scan(commit).drop(_VERSION)

    def _directories(self, commit: Commit) -> list[str]:
        return [
            f"{self.path}/data/{_VERSION}={v}" for v in range(commit.base_version, commit.version + 1)
        ]

    def _scan(self, commit: Commit) -> DataFrame:
        schema = commit.schema
        df = (
            self.spark.read.schema(T.StructType([*schema.fields, T.StructField(_VERSION, T.LongType())]))
            .option("basePath", f"{self.path}/data")
            .parquet(*self._directories(commit))
        )
        return self._live(df, commit).select(*schema.names, _VERSION)

    def _live(self, df: DataFrame, commit: Commit) -> DataFrame:
        """Drop rows of directories a later commit replaced; filters on partition columns only, each a hashed set."""
        key = _partition_key(commit.partition_by)
        for version, keys in commit.replaced.items():
            df = df.where((F.col(_VERSION) >= version) | ~key.isin(list(keys)))
        return df

    def live_files(self, commit: Commit | None = None) -> DataFrame:
        """Path, size and partition of every file of the table; lists files, opens none."""
        commit = commit or self.commit_at()
        files = self._files(self._directories(commit), commit.schema, commit.partition_by)
        return self._live(files, commit)

    def _files(self, directories: list[str], schema: T.StructType, partition_by: Sequence[str]) -> DataFrame:
        return list_files(self.spark, *directories, pattern="*.parquet").select(
            "path",
            "length",
            _path_value(_VERSION, T.LongType()).alias(_VERSION),
            *[_path_value(c, schema[c].dataType).alias(c) for c in partition_by],
        )

    # -- writes ------------------------------------------------------------------

    def overwrite(self, df: DataFrame, **how) -> Commit:
        """Replace all rows; columns the new rows lack stay in the schema as NULL."""
        return self._write(df, "Overwrite", **how)

    def append(self, df: DataFrame, **how) -> Commit:
        """Add rows; only the new rows are written."""
        return self._write(df, "Append", **how)

    def replace_partitions(self, df: DataFrame, **how) -> Commit:
        """Replace the partitions that occur in ``df`` and keep all others."""
        return self._write(df, "ReplacePartitions", **how)

    def _write(
        self,
        df: DataFrame,
        mode: str,
        *,
        batch_id: str | None = None,
        timestamp: datetime | None = None,
        rebalance: bool = False,
    ) -> Commit:
        """Write one version.

        ``batch_id`` (``<writer>_<number>``) makes the write idempotent: the last
        batch of a writer, when it is committed, is not written again.
        ``rebalance`` evens out file sizes per partition (splitting a hot one) for
        the price of a shuffle; leave it off when a batch lands in one partition
        anyway.
        """
        last = self.commit_at()
        done = self._committed(last, batch_id)
        if done:
            return done
        by = self._partitioning(last)
        if mode == "ReplacePartitions" and not by:
            raise ValueError("replace_partitions needs a partitioned table")
        version = last.version + 1 if last else 0
        schema = merge_schemas(last.schema if last else None, df.schema)
        if rebalance:
            df = df.hint("rebalance", *by)
        counted, counts = _observe(df, rows=F.count(F.lit(1)))
        self._save(counted, version, by)

        base, replaced = version, {}
        if last and mode != "Overwrite":
            base, replaced = last.base_version, last.replaced
        if last and mode == "ReplacePartitions":
            replaced = _replacing(replaced, version, self._keys_of_version(version, schema, by))
        files, size = self._written(version, schema, by)
        return self._commit(
            version=version,
            base_version=base,
            timestamp=timestamp,
            operation="WRITE",
            operation_parameters={"mode": mode, "partitionBy": ",".join(by)},
            # Fixed values, here and in _mutate: operation and metric names that readers of the history look up.
            operation_metrics={
                "numOutputRows": counts.get["rows"],
                "numFiles": files,
                "numOutputBytes": size,
            },
            batches=_batches(last, batch_id, version),
            schema=schema,
            replaced=replaced,
            partition_by=by,
        )

    def compact(self, **how) -> Commit | None:
        """Write the live rows as one version, so that reads open one directory; None without a table."""
        last = self.commit_at()
        return None if last is None else self.overwrite(self.read_commit(last), **how)

    def update(
        self,
        condition: str,
        assignments: Mapping[str, str],
        *,
        batch_id: str | None = None,
        timestamp: datetime | None = None,
    ) -> Commit | None:
        """``UPDATE SET .. WHERE``; rows whose condition is NULL keep their values.

        Returns None, and writes nothing, when no row matches.
        """
        hit = _matches(condition)

        def rewrite(df: DataFrame) -> DataFrame:
            unknown = set(assignments) - set(df.columns)
            if unknown:
                raise ValueError(f"no such columns: {sorted(unknown)}")
            # One select, so every right-hand side and the condition see the old values.
            return df.select(
                *[
                    F.when(hit, F.expr(assignments[f.name]).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
                    if f.name in assignments
                    else F.col(f.name)
                    for f in df.schema.fields
                ]
            )

        return self._mutate("UPDATE", condition, hit, rewrite, batch_id, timestamp, assignments)

    def delete(
        self, condition: str, *, batch_id: str | None = None, timestamp: datetime | None = None
    ) -> Commit | None:
        """``DELETE WHERE``: only rows whose condition is true go; None when there are none."""
        hit = _matches(condition)
        return self._mutate("DELETE", condition, hit, lambda df: df.where(~hit), batch_id, timestamp)

    def _mutate(
        self, operation, condition, hit: Column, rewrite, batch_id, timestamp, assigned=()
    ) -> Commit | None:
        last = self.commit_at()
        done = self._committed(last, batch_id)
        if done:
            return done
        if last is None:
            raise ValueError(f"no table at {self.path}")
        by = self._partitioning(last)
        if set(assigned) & set(by):
            raise ValueError("a partition column cannot be assigned")
        table = self._scan(last)
        # Only partitions that hold a match are rewritten. Collected is one row per such
        # partition, a directory name and its matches.
        found = table.where(condition).groupBy(_partition_key(by).alias("key")).agg(F.count(F.lit(1)).alias("n")).collect()
        if not found:
            return None
        hits = sum(r.n for r in found)
        touched = [r.key for r in found]

        def within(df: DataFrame) -> DataFrame:
            return df.where(_partition_key(by).isin(touched)) if by else df

        version = last.version + 1
        part = within(table).drop(_VERSION)
        # Counted above a delete's filter: below one that folds to nothing, the counter would go with it.
        counted, counts = _observe(rewrite(part), rows=F.count(F.lit(1)))
        self._save(counted, version, by)
        kept = counts.get["rows"] - (hits if operation == "UPDATE" else 0)
        removed = _files_and_bytes(within(self.live_files(last)))
        files, size = self._written(version, last.schema, by)
        return self._commit(
            version=version,
            base_version=last.base_version if by else version,
            timestamp=timestamp,
            operation=operation,
            operation_parameters={"predicate": condition},
            operation_metrics={
                "numUpdatedRows" if operation == "UPDATE" else "numDeletedRows": hits,
                "numCopiedRows": kept,
                "numAddedFiles": files,
                "numAddedBytes": size,
                "numRemovedFiles": removed["files"],
                "numRemovedBytes": removed["bytes"],
            },
            batches=_batches(last, batch_id, version),
            schema=last.schema,
            replaced=_replacing(last.replaced, version, touched) if by else {},
            partition_by=by,
        )

    # -- helpers -----------------------------------------------------------------

    def _committed(self, last: Commit | None, batch_id: str | None) -> Commit | None:
        """The commit of a batch, if the batch was its writer's last one."""
        check_batch_id(batch_id)
        version = last.batches.get(batch_id) if last and batch_id else None
        return None if version is None else self.commit_at(version)

    def _partitioning(self, last: Commit | None) -> tuple[str, ...]:
        """The table's own partition columns; the caller's for a new table."""
        if last is None:
            return self.partition_by
        if self.partition_by and tuple(last.partition_by) != self.partition_by:
            raise ValueError(f"table is partitioned by {last.partition_by}, not {list(self.partition_by)}")
        return tuple(last.partition_by)

    def _save(self, df: DataFrame, version: int, by: Sequence[str]) -> None:
        # Overwrite: the directory can only hold the rest of a write that never committed.
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if by:
            writer = writer.partitionBy(*by)
        writer.parquet(f"{self.path}/data/{_VERSION}={version}")

    def _version_files(self, version: int, schema: T.StructType, by: Sequence[str]) -> DataFrame:
        return self._files([f"{self.path}/data/{_VERSION}={version}"], schema, by)

    def _written(self, version: int, schema: T.StructType, by: Sequence[str]) -> tuple[int, int]:
        row = _files_and_bytes(self._version_files(version, schema, by))
        return row["files"], row["bytes"]

    def _keys_of_version(self, version: int, schema: T.StructType, by: Sequence[str]) -> list[str]:
        """Partition keys of a written version, from its file paths."""
        files = self._version_files(version, schema, by)
        return [r.key for r in files.select(_partition_key(by).alias("key")).distinct().collect()]

    def _commit(self, *, schema: T.StructType, timestamp, operation_metrics, partition_by, **fields) -> Commit:
        commit = Commit(
            timestamp=timestamp or datetime.now(timezone.utc),
            operation_metrics={k: str(v) for k, v in operation_metrics.items()},
            table_schema=schema.json(),
            partition_by=list(partition_by),
            **fields,
        )
        row = {name: getattr(commit, name) for name in COMMIT_SCHEMA.names}
        one_row(self.spark, COMMIT_SCHEMA, row).write.mode("overwrite").parquet(self._commit_path(commit.version))
        self._known = commit.version
        return commit


def _newest(rows: DataFrame) -> Commit | None:
    row = rows.orderBy(F.desc("version")).limit(1).collect()
    return Commit(**row[0].asDict()) if row else None


def _replacing(before: Mapping[int, Sequence[str]], version: int, keys: Sequence[str]) -> dict[int, list[str]]:
    """Partitions by the version that replaced them last, after ``version`` replaced ``keys``."""
    new = set(keys)
    left = {v: [k for k in old if k not in new] for v, old in before.items()}
    return {v: old for v, old in left.items() if old} | ({version: sorted(new)} if new else {})


def check_batch_id(batch_id: str | None) -> None:
    """A batch id names its writer and its number, so that writers do not push out each other's batches."""
    if batch_id is not None and not re.fullmatch(r"[\w.-]*[\w.-]_\d+", batch_id):
        raise ValueError(f"a batch id must look like <writer>_<number>: {batch_id!r}")


def _batches(last: Commit | None, batch_id: str | None, version: int) -> dict[str, int]:
    """The last batch of each writer and its version, after this commit."""
    known = dict(last.batches) if last else {}
    if batch_id is None:
        return known
    writer = batch_id.rpartition("_")[0]
    return {b: v for b, v in known.items() if b.rpartition("_")[0] != writer} | {batch_id: version}


def _matches(condition: str) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False))


def _partition_key(columns: Sequence[str]) -> Column:
    """One text per partition; a NULL partition value is a key of its own.

    Values are cast before they are put into JSON, which would print times to milliseconds only.
    """
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns])) if columns else F.lit("{}")


def _path_value(column: str, kind: T.DataType) -> Column:
    """A Hive partition value out of a file path, as the table's own type."""
    text = F.regexp_extract("path", rf"/\Q{column}\E=([^/]*)/", 1)
    # Fixed value: the directory name Spark gives a NULL partition value.
    text = F.nullif(text, F.lit("__HIVE_DEFAULT_PARTITION__"))
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))).cast(kind)


def _files_and_bytes(files: DataFrame) -> Row:
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    ).first()


def _observe(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Count rows inside the write job itself.

    ``df`` must reach the write without a shuffle or filter in between: the
    counters then sit in the job's last stage, where Spark merges each task's
    numbers once even if an executor is lost and the task runs again.
    """
    seen = Observation()
    return df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), seen
