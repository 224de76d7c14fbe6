"""Row cleaning: one row per key, distinct rows, NULL defaults, derived date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_by_key(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str] = (), last: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the first by ``order_by``, then by the remaining columns.

    Rows with a NULL key form one group. A NULL cell comes after any value, so of two rows that are
    equal otherwise the fuller one stays. The tie-breaks make the survivor the
    same on every run; ``last`` names columns that decide only after all others.

    ``row_number() = 1`` lets Spark plan a group limit in front of the shuffle:
    each map task sends at most one row per key, so a key that holds a third of
    all rows arrives as one row per task.
    """
    ordered = [*order_by]
    ordered += [c for c in df.columns if c not in key and c not in ordered and c not in last]
    ordered += [c for c in last if c not in ordered and c not in key]
    first = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_last() for c in ordered or key])
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-row dedup, over ``columns`` only when given; partial aggregation cuts repeats before the shuffle."""
    return (df.select(*columns) if columns else df).distinct()


def fill_nulls(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace NULL by a default, per column; all other cells stay."""
    return df.fillna(dict(defaults)) if defaults else df


def derive_date(df: DataFrame, time_column: str, date_column: str) -> DataFrame:
    """Calendar date of a timestamp in the session time zone."""
    return df.withColumn(date_column, F.to_date(time_column))
