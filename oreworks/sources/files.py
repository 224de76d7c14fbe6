"""Raw file drops: CSV with header and JSON lines, read under an explicit schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.sources.listing import any_file


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    *,
    file_column: str | None = None,
    check_header: bool = True,
) -> DataFrame:
    """CSV files with a header line; a cell that does not parse becomes NULL.

    Spark binds CSV columns by position. With ``check_header`` a header whose
    names are in another order fails the read instead of filling wrong columns.
    """
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", not check_header)
        .csv(path if isinstance(path, str) else list(path))
    )
    return with_source_file(df, file_column) if file_column else df


def read_json(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, *, file_column: str | None = None
) -> DataFrame:
    """JSON-lines files; a line that does not parse becomes a row of NULLs."""
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path if isinstance(path, str) else list(path))
    return with_source_file(df, file_column) if file_column else df


def with_source_file(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Add the file each row came from.

    Taken from the scan's hidden metadata, so it has to be applied to a source
    before any union.
    """
    return df.select("*", F.col("_metadata.file_path").alias(column))


def union_sources(sources: Iterable[DataFrame | None]) -> DataFrame | None:
    """All rows of the sources that exist, matched by column name; None when there are none."""
    present = [s for s in sources if s is not None]
    return reduce(DataFrame.unionByName, present) if present else None


def read_drop(
    spark: SparkSession, folder: str, schema: T.StructType, *, file_column: str = "source_file"
) -> DataFrame | None:
    """Every ``*.csv`` and ``*.json`` file of a folder as one frame with its source file."""
    csv, json = f"{folder}/*.csv", f"{folder}/*.json"
    return union_sources(
        [
            read_csv(spark, csv, schema, file_column=file_column) if any_file(spark, csv) else None,
            read_json(spark, json, schema, file_column=file_column) if any_file(spark, json) else None,
        ]
    )


def stamp(df: DataFrame, column: str = "ingestion_time", at: datetime | Column | None = None) -> DataFrame:
    """Give every row one ingestion time: the query's clock, or ``at`` for repeatable results."""
    if at is None:
        return df.withColumn(column, F.current_timestamp())
    return df.withColumn(column, at if isinstance(at, Column) else F.lit(at))
