"""Ordered full export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def export_csv(df: DataFrame, path: str, order: Sequence[Column]) -> None:
    """Write all rows as CSV in one global order: part files by name, rows within a file.

    Every part has a header line. Quotes inside cells are doubled, NULL and empty
    text are empty cells, times keep their microseconds. The row id behind the
    order lets the range partitioning split rows whose order values are equal
    over several tasks.
    """
    columns = df.columns
    (
        df.withColumn("_row", F.monotonically_increasing_id())
        .orderBy(*order, "_row")
        .select(*columns)
        .write.mode("errorifexists")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("emptyValue", "")
        .option("timestampFormat", TIME_FORMAT)
        .option("timestampNTZFormat", TIME_FORMAT)
        .csv(path)
    )
