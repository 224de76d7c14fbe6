"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from oreworks.sources.listing import delete_at_exit

_SHUFFLES = "spark.sql.shuffle.partitions"


def build_session(app_name: str = "oreworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC dates and adaptive execution.

    Memory, cores and shuffle partitions belong to the launcher; AQE coalesces
    shuffle output, so no fixed partition count is set here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``, removed when the driver ends.

    Only a local session may do without the setting and use a temporary folder of this machine:
    on a cluster the executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="oreworks-")
    folder = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    delete_at_exit(spark, folder)
    return f"{folder}/rows"


def wanted_partitions(input_bytes: int, target_bytes: int = 128 * 1024 * 1024, at_most: int | None = None) -> int:
    """Shuffle partitions of about ``target_bytes`` each; ``at_most``, if given, makes them larger instead."""
    wanted = max(1, -(-input_bytes // target_bytes))
    return min(wanted, at_most) if at_most else wanted


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int, **how) -> Iterator[int]:
    """Inside, ``spark.sql.shuffle.partitions`` fits the input and is never lower than before; after, it is as it was.

    AQE merges partitions that turn out small but never adds any, so the number
    has to fit the input: the default would mean half a terabyte per task at 100 TB.
    """
    before = spark.conf.get(_SHUFFLES)
    spark.conf.set(_SHUFFLES, str(max(int(before), wanted_partitions(input_bytes, **how))))
    try:
        yield int(spark.conf.get(_SHUFFLES))
    finally:
        spark.conf.set(_SHUFFLES, before)
