"""Append-only logs of a few rows per run: quality metrics, incidents, run times.

Layout of one log::

    <path>/records/month=<yyyy-MM>/record_id=<id>/   the rows of one record
    <path>/merged/month=<yyyy-MM>/                   all rows of a closed month

A merged month keeps the id of each row's record. Records with an id in there count no more and are removed; one that came while the
month was merged counts beside it and stays.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from oreworks.sources.listing import delete_path, folder_names, path_exists

_MONTH, _RECORD = "month", "record_id"


def one_row(spark: SparkSession, schema: T.StructType, row: Mapping[str, Any]) -> DataFrame:
    """A single literal row under an explicit schema; Arrow input needs no Python task.

    A datetime without a zone is local time, as everywhere in PySpark.
    """

    def cell(value: Any) -> Any:
        if isinstance(value, Mapping):
            return list(value.items())
        return value.astimezone(timezone.utc) if isinstance(value, datetime) else value

    cells = {name: cell(value) for name, value in row.items()}
    return spark.createDataFrame(pa.Table.from_pylist([cells], schema=to_arrow_schema(schema)), schema)


def _month_of(at: datetime | None) -> str:
    return f"{(at or datetime.now(timezone.utc)).astimezone(timezone.utc):%Y-%m}"


def append_rows(df: DataFrame, path: str, record_id: str | None = None, at: datetime | None = None) -> None:
    """Append the rows of ``df`` as one record of the month of ``at`` (now by default).

    A record owns its own sub-folder, so writing it again under the same
    ``record_id`` and month (a retried batch) replaces it instead of doubling it. A month that is
    closed takes no more records: one it holds is left as it is, others go to the present month.
    """
    record_id = record_id or uuid.uuid4().hex
    if not re.fullmatch(r"[\w.-]+", record_id):
        raise ValueError(f"record id must be a plain name: {record_id!r}")
    spark, month = df.sparkSession, _month_of(at)
    if path_exists(spark, f"{_merged(path, month)}/_SUCCESS"):
        if record_id in _merged_ids(spark, path, month):
            return
        if not path_exists(spark, f"{_records(path, month)}/{_RECORD}={record_id}"):
            month = _month_of(None)
    df.write.mode("overwrite").parquet(f"{_records(path, month)}/{_RECORD}={record_id}")


def _records(path: str, month: str) -> str:
    return f"{path}/records/{_MONTH}={month}"


def _merged(path: str, month: str) -> str:
    return f"{path}/merged/{_MONTH}={month}"


def _merged_ids(spark: SparkSession, path: str, month: str) -> set[str]:
    """Ids of the records that a merged month holds, one per run of that month."""
    ids = spark.read.schema(f"{_RECORD} string").parquet(_merged(path, month))
    return {r[0] for r in ids.distinct().collect()}


def _complete(spark: SparkSession, path: str, month: str) -> list[str]:
    """Ids of a month's single records that are written to the end."""
    folder = _records(path, month)
    names = [n for n in folder_names(spark, folder) if n.startswith(f"{_RECORD}=")]
    return [n.partition("=")[2] for n in names if path_exists(spark, f"{folder}/{n}/_SUCCESS")]


def _months(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Month -> folders that hold its rows, oldest first."""
    found = {name.partition("=")[2]: [f"{path}/records/{name}"] for name in folder_names(spark, f"{path}/records") if "=" in name}
    for name in folder_names(spark, f"{path}/merged"):
        month = name.partition("=")[2]
        if path_exists(spark, f"{path}/merged/{name}/_SUCCESS"):
            found[month] = [_merged(path, month), *_late(spark, path, month)]
    return {month: found[month] for month in sorted(found)}


def _late(spark: SparkSession, path: str, month: str) -> list[str]:
    """Folders of single records that a merged month does not hold."""
    single = _complete(spark, path, month)
    held = _merged_ids(spark, path, month) if single else set()
    return [f"{_records(path, month)}/{_RECORD}={i}" for i in single if i not in held]


def _read(spark: SparkSession, folders: list[str], schema: T.StructType, record_id: bool = False) -> DataFrame | None:
    """The rows of the folders, if wanted with the id that their folder names."""
    if not folders:
        return None
    of_folder = F.regexp_extract("_metadata.file_path", f"/{_RECORD}=([^/]+)/", 1).alias(_RECORD)
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders)
    return rows.select(*schema.names, *[of_folder] * record_id)


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """All records, or None when nothing was ever appended."""
    return _read(spark, [f for folders in _months(spark, path).values() for f in folders], schema)


def read_newest_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Records of the newest month that has any: what the latest row is looked up in, however long the log."""
    months = list(_months(spark, path).values())
    return _read(spark, months[-1] if months else [], schema)


def merge_closed_months(spark: SparkSession, path: str, schema: T.StructType, now: datetime | None = None) -> list[str]:
    """Rewrite each month before the present one as one small table; returns the months merged.

    The records found complete at the start are read, and only records that the merged table holds go once it has its success mark. So a merge
    that dies half-way, or a record written meanwhile, loses and doubles nothing.
    """
    done = []
    for month, folders in _months(spark, path).items():
        merged, ids = _merged(path, month), _complete(spark, path, month)
        if month < _month_of(now) and merged not in folders and ids:
            rows = _read(spark, [f"{_records(path, month)}/{_RECORD}={i}" for i in ids], schema, record_id=True)
            rows.coalesce(1).write.mode("overwrite").parquet(merged)
            done.append(month)
        if ids and path_exists(spark, f"{merged}/_SUCCESS"):
            for held in _merged_ids(spark, path, month) & set(ids):
                delete_path(spark, f"{_records(path, month)}/{_RECORD}={held}")
            if not folder_names(spark, _records(path, month)):
                delete_path(spark, _records(path, month))
    return done
