"""Benchmark decontamination by template canonicalisation.

Numbers, names and units give way to typed placeholders; windows of the canonical words are
joined by hash. Where windows agree, the values behind the placeholders must answer each other: within one
copy every value of the item has one value in the document, but for single slots that differ. A question with
other numbers or names is thus found, an accidental mix of values is not. Windows of plain words in lower case are
joined beside them. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreworks.llm.common import written

WINDOW = 8
# Share of an item's words that its windows in one document must cover.
COVERAGE = 0.5
# Words an item must have beside its placeholders to be found with other values.
LEAST_LITERALS = 4
# A benchmark of at most this many windows is broadcast (32 bytes each); a larger one is joined by shuffle.
BROADCAST_WINDOWS = 2_000_000
# So many hashes or ids of documents found are broadcast at most (8 bytes each); more are joined by shuffle.
BROADCAST_FOUND = 2_000_000

NUMBER, NAME, UNIT = "0", "\ue000", "\ue001"
# Unit words that may follow a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons pound pounds ounce ounces "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months "
    "year years cent cents dollar dollars euro euros percent degree degrees mph kph volt volts watt watts joule joules hertz"
).split()


NUMERAL = r"\p{N}+(?:[.,]\p{N}+)*"
# Stands for the blank inside a run of names.
GLUE = "\ue002"


def _glued(text: Column) -> Column:
    """White space as single blanks, and the names of a run as one word."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")
    return F.regexp_replace(spaced, r" (?=\p{Lu})(?<=[\p{L}\p{N},;)] \p{Lu}\p{L}{0,64} )", GLUE)


def raw_words(text: Column) -> Column:
    """Words, runs of names and whole numbers (with separators and decimals), as written."""
    return F.regexp_extract_all(_glued(text), F.lit(rf"([\p{{L}}{GLUE}]+|{NUMERAL})"), F.lit(0))


def canonical_words(text: Column) -> Column:
    """One word per raw word: names, numbers and units as placeholders, the rest in lower case.

    A name is a capitalised word inside a sentence, that is after a letter, digit, comma, semicolon or bracket and white space.
    """
    # The dotted capital I becomes two characters in lower case and would split its word.
    text = F.replace(_glued(text), F.lit("\u0130"), F.lit("I"))
    named = F.regexp_replace(text, rf"\p{{Lu}}(?<=[\p{{L}}\p{{N}},;)] .)[\p{{L}}{GLUE}]*", NAME)
    numbered = F.regexp_replace(F.lower(named), NUMERAL, NUMBER)
    units = F.regexp_replace(numbered, rf"(?<=0 ?)(?:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?!\p{{L}})", UNIT)
    return F.regexp_extract_all(units, F.lit(rf"([\p{{L}}{GLUE}]+|{NUMBER}|{NAME}|{UNIT})"), F.lit(0))


def plain_words(text: Column) -> Column:
    """Runs of letters and runs of digits in lower case."""
    text = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u0130"), F.lit("I")))
    return F.regexp_extract_all(text, F.lit(r"(\p{L}+|\p{N}+)"), F.lit(0))


# Windows of both kinds are hashed: canonical ones find other values, plain ones copies that differ in case or breaks.
KINDS = {"canonical": canonical_words, "plain": plain_words}


def _hash(kind: str, text: Column) -> Column:
    return F.xxhash64(F.lit(kind), text)


def _windows(rows: DataFrame, kind: str, width: int, *keep: str) -> DataFrame:
    """(.., words) -> (.., at, width, h): hashed windows; fewer words than the width make none."""
    n = F.size("words")
    starts = F.when(n >= width, F.sequence(F.lit(0), n - width))
    text = F.concat_ws(" ", *[F.get("words", F.col("at") + k) for k in range(width)])
    return rows.select(*keep, "words", F.explode(starts).alias("at")).select(
        *keep, "at", F.lit(width).alias("width"), _hash(kind, text).alias("h")
    )


def item_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """(item_id, text, ..) -> item_id, kind, item_at, width, n (words of the item), h; an item shorter than the width is one window.

    An item of fewer than LEAST_LITERALS words beside its placeholders has plain windows only, so its values must be equal too.
    """
    out = None
    for kind, words in KINDS.items():
        items = benchmark.where("item_id is not null").select("item_id", F.lit(kind).alias("kind"), words(F.col("text")).alias("words"))
        if kind == "canonical":
            literals = F.filter("words", lambda w: ~w.isin(NUMBER, NAME, UNIT))
            items = items.where(F.size(literals) >= LEAST_LITERALS)
        items = items.where(F.size("words") > 0).withColumn("n", F.size("words"))
        whole = items.where(F.size("words") < width).select(
            "item_id", "kind", "n", F.lit(0).alias("at"), F.size("words").alias("width"), _hash(kind, F.concat_ws(" ", "words")).alias("h")
        )
        both = _windows(items, kind, width, "item_id", "kind", "n").unionByName(whole).withColumnRenamed("at", "item_at")
        out = both if out is None else out.unionByName(both)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """docs (doc_id, text, ..), benchmark (item_id, text, ..) -> doc_id, item_ids, coverage, n_slots: documents that hold an item.

    A document holds an item if windows of one alignment, or of alignments near each other, whose slots are consistent cover at least
    ``coverage`` of its words. n_slots counts values found reworded or repeated behind placeholders. NULL and empty texts hold nothing; rows
    without doc_id are judged as one row each and appear with a NULL id. Repeated rows of one id count once.
    """
    index = written(item_windows(benchmark, width), "item_windows")
    widths = [tuple(r) for r in index.select("kind", "width").distinct().collect()]  # at most twice ``width`` rows
    n_windows = index.count()
    side = F.broadcast(index) if n_windows <= BROADCAST_WINDOWS else index
    hits = None
    for kind, w in sorted(widths):
        rows = docs.select(_row_key(), "doc_id", KINDS[kind](F.col("text")).alias("words"))
        own = side.where((F.col("width") == w) & (F.col("kind") == kind)).drop("width")
        found = _windows(rows, kind, w, "row", "doc_id").join(own, "h")
        found = found.select("row", "doc_id", "item_id", "kind", "n", F.lit(w).alias("width"), "at", "item_at")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        none = [F.lit(None).cast("long").alias("item_id"), F.lit("").alias("kind"), *[F.lit(0).alias(c) for c in ("n", "width", "at", "item_at")]]
        hits = docs.where("false").select(_row_key(), "doc_id", *none)
    hits = written(hits, "window_hits")
    return _judged(hits, docs, benchmark, coverage)


def _broadcast_if_few(keys: DataFrame) -> DataFrame:
    """A written table of keys, marked for broadcast if its count is within the bound."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_FOUND else keys


def _row_key() -> Column:
    """The same for a row in every scan; equal rows are one."""
    return F.xxhash64("doc_id", "text").alias("row")


ALIGN = ["row", "doc_id", "item_id", "kind", "n", "part"]


def _aligned(hits: DataFrame) -> DataFrame:
    """Every hit in its alignment (one shift), and once more in the union of shifts near each other if there are several.

    Shifts differ where words were put in or left out. They are near if the next one is at most a window or half an item away.
    """
    item = ["row", "doc_id", "item_id", "kind", "n"]
    hits = hits.distinct().withColumn("shift", F.col("at") - F.col("item_at"))
    in_order = Window.partitionBy(*item).orderBy("shift", "item_at", "width")
    far = F.col("shift") - F.lag("shift").over(in_order) > F.greatest(F.lit(WINDOW), F.floor(F.col("n") / 2))
    hits = hits.withColumn("far", F.coalesce(far, F.lit(False)).cast("int"))
    hits = hits.withColumn("run", F.sum("far").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    of_run = Window.partitionBy(*item, "run")
    united = F.when(F.min("shift").over(of_run) < F.max("shift").over(of_run), F.concat(F.lit("run "), "run"))
    hits = hits.withColumn("united", united)
    parts = F.array_compact(F.array(F.concat(F.lit("shift "), "shift"), "united"))
    return hits.select(*item, "shift", F.col("item_at").alias("start"), "width", F.explode(parts).alias("part"))


def _judged(hits: DataFrame, docs: DataFrame, benchmark: DataFrame, coverage: float) -> DataFrame:
    """Coverage and slot consistency of every (row, item, alignment).

    Slots of one value in one role should have one answer. A role is the value, of a number with the literal word after it. Windows on slots
    that disagree with the answer of more than half of their role do not count; a role without such an answer rejects the alignment.
    """
    placed = written(_aligned(hits), "alignments")
    ends = F.col("start") + F.col("width") - 1
    covered = placed.select(*ALIGN, "shift", "start", F.explode(F.sequence(F.col("start"), ends)).alias("item_at"))
    pairs = F.arrays_zip(canonical_words(F.col("text")).alias("c"), raw_words(F.col("text")).alias("v"))
    items = benchmark.where("item_id is not null").select("item_id", F.posexplode(pairs).alias("item_at", "word"), pairs.alias("words"))
    after = F.get("words", F.col("item_at") + 1)
    role = F.when((F.col("word.c") == NUMBER) & ~after["c"].isin(NUMBER, NAME, UNIT), after["c"])
    items = items.select("item_id", "item_at", "word.c", F.lower("word.v").alias("item_value"), F.coalesce(role, F.lit("")).alias("role"))
    items = items.where(F.col("c").isin(NUMBER, NAME, UNIT))
    slots = covered.where("kind = 'canonical'").drop("start").distinct().join(items, ["item_id", "item_at"])
    at_risk = _broadcast_if_few(written(slots.select("row").distinct(), "at_risk"))
    values = docs.select(_row_key(), "text").join(at_risk, "row").dropDuplicates(["row"])
    slots = slots.join(values.select("row", raw_words(F.col("text")).alias("values")), "row")
    slots = slots.withColumn("doc_value", F.lower(F.get("values", F.col("shift") + F.col("item_at")))).drop("values")
    of_role = Window.partitionBy(*ALIGN, "c", "item_value", "role")
    of_answer = Window.partitionBy(*ALIGN, "c", "item_value", "role", "doc_value")
    slots = slots.withColumn("same", F.count(F.lit(1)).over(of_answer)).withColumn("slots", F.count(F.lit(1)).over(of_role))
    slots = slots.withColumn("most", F.max("same").over(of_role)).withColumn("odd", F.col("same") < F.col("slots"))
    slots = slots.withColumn("minor", F.col("odd") & (F.col("same") * 2 <= F.col("slots")))
    slots = written(slots.drop("same"), "slots")
    # "odd": the role has several answers; "minor": this slot's answer is not that of over half.
    mixed = slots.groupBy(*ALIGN).agg(
        F.count_if(F.col("odd") & (F.col("most") * 2 <= F.col("slots"))).alias("unsettled"),
        F.count_distinct("c", "item_value", "role").cast("long").alias("n_slots"),
    )
    minor = slots.where("minor").select(*[F.col(c).alias(f"_{c}") for c in [*ALIGN, "shift", "item_at"]])
    on_minor = covered.join(minor, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*ALIGN, "shift", "item_at"]])
    dropped = on_minor.select(*[F.col(f"_{c}") for c in [*ALIGN, "shift"]], F.col("start").alias("_start")).distinct()
    left = covered.join(dropped, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*ALIGN, "shift", "start"]], "left_anti")
    spans = left.groupBy(*ALIGN).agg(F.count_distinct("item_at").alias("words"))
    mixed = mixed.select(*[F.col(c).alias(f"_{c}") for c in ALIGN], "unsettled", "n_slots")
    judged = spans.join(mixed, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ALIGN], "left").where(
        (F.col("words") >= coverage * F.col("n")) & (F.coalesce("unsettled", F.lit(0)) == 0)
    )
    return judged.groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.max(F.col("words") / F.col("n")).alias("coverage"),
        F.max(F.coalesce("n_slots", F.lit(0).cast("long"))).alias("n_slots"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark item, all columns. Rows without an id stay."""
    found = contaminated(docs, benchmark).where("doc_id is not null").select("doc_id")
    return docs.join(_broadcast_if_few(written(found, "contaminated")), "doc_id", "left_anti").select(*docs.columns)
