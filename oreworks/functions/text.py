"""Text formats of the monitoring views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The display formats and the failure message.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
FAILURE_MESSAGE = "FAILURE in task '%s': %s..."
FAILURE_DETAIL_CHARS = 200
PROFILE_NAME = "s%dd%dn%d_%s"


def timestamp_text(ts: Column) -> Column:
    """Seconds-precision text, empty when NULL."""
    return F.coalesce(F.date_format(ts, TIMESTAMP_FORMAT), F.lit(""))


def two_decimals(x: Column) -> Column:
    return F.format_string("%.2f", x.cast("double"))


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def percent(ratio: Column) -> Column:
    return F.format_string("%.2f%%", ratio * 100)


def metric_number(metrics: Column, name: str) -> Column:
    """Whole number out of a string map; 0 for a missing map, key or number."""
    return F.coalesce(F.try_element_at(metrics, F.lit(name)).try_cast("bigint"), F.lit(0).cast("bigint"))


def failure_message(task_id: Column, detail: Column) -> Column:
    """The message of a failed task; the detail is cut to a fixed length."""
    shown = F.substring(F.coalesce(detail, F.lit("Unknown Error")), 1, FAILURE_DETAIL_CHARS)
    return F.format_string(FAILURE_MESSAGE, task_id, shown)


def run_id(started: Column) -> Column:
    return F.concat(F.lit("run_"), F.unix_timestamp(started).cast("string"))


def is_blank(cell: Column) -> Column:
    """True for NULL, empty and all-whitespace cells.

    SQL ``trim`` strips spaces only; the Unicode class plus the four separator
    control characters is what a full whitespace strip removes.
    """
    return F.coalesce(cell.rlike(r"(?U)^[\s\x1c-\x1f]*$"), F.lit(True))
