"""Files and folders of any Hadoop file system: listings as DataFrames, and single look-ups."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A listing does no work per byte, but Spark plans one task per 128 MB of the
# files listed; merged, even a 100 TB folder takes this many tasks at most.
LISTING_TASKS = 256


def _at(spark: SparkSession, path: str):
    """File system and path object."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none when it does not exist."""
    fs, target = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.delete(target, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the folder removed when the driver ends."""
    fs, target = _at(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)


class FileEntry(NamedTuple):
    name: str
    modified_ms: int
    length: int


def files_in(spark: SparkSession, path: str) -> list[FileEntry]:
    """The files directly in a folder, by name; none when it does not exist."""
    fs, target = _at(spark, path)
    found = fs.listStatus(target) if fs.exists(target) else []
    return sorted(FileEntry(s.getPath().getName(), s.getModificationTime(), s.getLen()) for s in found if s.isFile())


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.mkdirs(target)


def list_files(spark: SparkSession, *folders: str, pattern: str = "*") -> DataFrame:
    """Path, modification time and length of every file below the folders; no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(list(folders))
        .select("path", "modificationTime", "length")
        .coalesce(LISTING_TASKS)
    )


def any_file(spark: SparkSession, pattern: str) -> bool:
    """Whether a path pattern matches anything; asked of the file system, so that no query has to fail for it."""
    fs, target = _at(spark, pattern)
    return bool(fs.globStatus(target))


def total_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder; 0 when it does not exist."""
    if not path_exists(spark, folder):
        return 0
    return list_files(spark, folder).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def place_file(spark: SparkSession, source: str, target: str, modified_ms: int | None = None) -> None:
    """Move a file to a path of its own, whose folder is made when absent; ``modified_ms`` sets its modification time."""
    fs, old = _at(spark, source)
    _, new = _at(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")
    if modified_ms is not None:
        fs.setTimes(new, modified_ms, -1)
