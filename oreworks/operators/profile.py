"""Per-file profile of raw CSV files: size, exact duplicate rows, empty cells."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreworks.functions.text import PROFILE_NAME, is_blank

# The inside of a quoted cell, where a doubled quote stands for one.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
# One whole cell with the separator in front, quoted or anything up to the next comma; and one that may end open at the end of a record.
_CLOSED = rf',(?:"{_QUOTED}"[^,]*+|(?!")[^,]*+)'
_CELL = rf',("{_QUOTED}(?:"[^,]*+|\z)|(?!")[^,]*+)'
_FILE = ["file_path", "file_name", "size_bytes"]


def _profile(rows: DataFrame, by: Sequence[str], row: Sequence[str], blanks: Column, copies: Column | None = None) -> DataFrame:
    """Rows, exact duplicate rows and empty cells per group; ``copies`` counts the rows that are alike, all of them by default.

    First one row per distinct row and its count (repeats shrink before the
    shuffle), then sums per group, so one huge file is still spread over all tasks.
    """
    return (
        rows.groupBy(*by, *row)
        .agg((F.count(F.lit(1)) if copies is None else copies).alias("copies"))
        .groupBy(*by)
        .agg(
            F.sum("copies").alias("n_rows"),
            F.sum(F.greatest(F.col("copies") - 1, F.lit(0))).alias("duplicate_rows"),
            F.sum(F.when(F.col("copies") > 0, blanks * F.col("copies")).otherwise(0)).alias("empty_cells"),
        )
    )


def profile_rows(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Profile of typed rows; a row is its ``columns``."""
    blanks = reduce(lambda a, b: a + b, [is_blank(F.col(c).cast("string")).cast("int") for c in columns])
    return _profile(df, by, columns, blanks)


def _cells(record: Column) -> Column:
    """Cells of a CSV record, quotes taken off; a blank line has none."""

    def bare(cell: Column) -> Column:
        inside = F.replace(F.regexp_extract(cell, f'^"({_QUOTED})', 1), F.lit('""'), F.lit('"'))
        return F.when(cell.startswith('"'), F.concat(inside, F.regexp_replace(cell, f'^"{_QUOTED}"?', ""))).otherwise(cell)

    cells = F.transform(F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_CELL), F.lit(1)), bare)
    return F.when(record == "", F.array().cast("array<string>")).otherwise(cells)


def _leaves_open(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside a quoted cell: whole cells do not use it up."""
    return F.regexp_replace(F.concat(F.lit(","), line), _CLOSED, "") != ""


def _with_states(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """Adds open_if_closed, open_if_open: whether a quote is open before a row, if none or one is before the first row of its group.

    from_closed and from_open tell what a row leaves behind, begun outside or inside quotes. A row that leaves the same either way settles it;
    every row since then turns it over or leaves it.
    """
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    turns = (F.col("from_closed") & ~F.col("from_open")).cast("int")
    settled = F.struct(F.col("from_closed").alias("open"), F.col("turned"))
    rows = rows.withColumn("turned", F.sum(turns).over(up_to)).withColumns(
        {
            "turned_before": F.coalesce(F.sum(turns).over(before), F.lit(0)),
            "settled": F.last(F.when(F.col("from_closed") == F.col("from_open"), settled), ignorenulls=True).over(before),
        }
    )
    odd = (F.col("turned_before") - F.coalesce("settled.turned", F.lit(0))) % 2 == 1
    states = {f"open_if_{name}": F.coalesce("settled.open", F.lit(first)) != odd for name, first in (("closed", False), ("open", True))}
    return rows.withColumns(states).drop("turned", "turned_before", "settled")


def csv_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.csv`` below ``folder`` -> file_path, file_name, size_bytes, number, record: text of the records, numbered from 1 in each file.

    A line break inside a quoted cell belongs to the cell, wherever the scan splits the file, and reads as a line feed. A quote counts where a cell
    begins with it; elsewhere it is a character like others. A quote that is never closed takes in the rest of the file.
    Each split adds up its own lines, for either state it may begin in; one row per split then tells in which state it
    did begin and how many records stand before it. So neither step sees a whole file of many splits.
    """
    split = ["file_path", "block"]
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .text(folder)
        .select(
            F.col("value").alias("line"),
            F.monotonically_increasing_id().alias("at"),
            *[F.col(f"_metadata.{m}").alias(n) for m, n in zip(("file_path", "file_name", "file_size"), _FILE, strict=True)],
            F.col("_metadata.file_block_start").alias("block"),
        )
        .withColumns({"from_closed": _leaves_open(F.col("line")), "from_open": _leaves_open(F.concat(F.lit('"'), "line"))})
    )
    so_far = Window.partitionBy(*split).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    begun = {f"n_if_{name}": F.sum((~F.col(f"open_if_{name}")).cast("long")).over(so_far) for name in ("closed", "open")}
    lines = _with_states(lines, split, "at").withColumns(begun)
    leaves = {name: F.when(F.col(f"open_if_{name}"), F.col("from_open")).otherwise(F.col("from_closed")) for name in ("closed", "open")}
    splits = lines.groupBy(*split).agg(
        *[F.max_by(leaf, "at").alias(f"from_{name}") for name, leaf in leaves.items()],
        *[F.max(f"n_if_{name}").alias(f"all_if_{name}") for name in ("closed", "open")],
    )
    earlier = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun_in = F.when(F.col("open_if_closed"), F.col("all_if_open")).otherwise(F.col("all_if_closed"))
    splits = _with_states(splits, ["file_path"], "block").select(
        *split, F.col("open_if_closed").alias("begins_open"), F.coalesce(F.sum(begun_in).over(earlier), F.lit(0)).alias("earlier")
    )
    own = F.when(F.col("begins_open"), F.col("n_if_open")).otherwise(F.col("n_if_closed"))
    numbered = lines.join(splits, split).withColumn("number", F.col("earlier") + own)
    in_order = F.array_sort(F.collect_list(F.struct("at", "line")))
    record = F.array_join(F.transform(in_order, lambda x: x["line"]), "\n")
    return numbered.groupBy(*_FILE, "number").agg(record.alias("record"))


def profile_csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """Profile every ``*.csv`` below ``folder`` in one job; the first record of a file is its header.

    Files may have any number of columns, each its own. A row is all its cells, however many it has; cells a short row lacks
    do not count as empty. ``profile_name`` is the name the file would get; nothing is renamed.
    A blank line is a row without cells, so repeated ones are duplicates. A file of a header alone has no rows; one without any line is left out.
    """
    header = F.col("number") == 1
    rows = csv_records(spark, folder).select(*_FILE, F.when(~header, _cells(F.col("record"))).alias("cells"))
    profile = _profile(rows, _FILE, ["cells"], F.size(F.filter("cells", is_blank)), F.count("cells"))
    # File names in the scan's metadata are URL-encoded.
    name = F.url_decode(F.replace("file_name", F.lit("+"), F.lit("%2B")))
    base = F.regexp_replace(name, "^.*?bytes_", "")
    return profile.withColumn(
        "profile_name",
        F.format_string(PROFILE_NAME, "size_bytes", "duplicate_rows", "empty_cells", base),
    )
