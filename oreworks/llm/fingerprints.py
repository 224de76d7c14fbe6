"""Document fingerprints: SimHash of weighted word pairs, and permuted block tables to search them.

Built-in functions only. Terms are adjacent word pairs (a lone word stands for itself), each
weighing one plus its words of four letters or more, so that runs of short common words
count least.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreworks.llm.common import with_rank, written
from oreworks.llm.simhash import BITS, differing_bits, positions, run_text, vote

PAIR = 2
LONG_WORD = 4
RADIUS = 3
BLOCKS = 5
# Ids of one bucket travel together, so that a text meets its successor: at most this many distinct ids.
BUCKET_IDS = 128
# Up to this many ends of buckets their ids are broadcast (32 bytes each), more are joined by shuffle.
BROADCAST_ENDS = 1_000_000


def text_fingerprints(texts: DataFrame, key: list[str]) -> DataFrame:
    """(key.., text) -> key.., fingerprint, one row per key; texts without words get 0.

    No exchange is needed for the terms: they are summed in the task that holds the text.
    """
    words = texts.select(
        *key, F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+"), "").alias("words")
    )
    terms = words.select(*key, "words", F.explode_outer(positions(F.size("words"), PAIR)).alias("at"))
    long_word = lambda k: F.coalesce((F.length(F.get("words", F.col("at") + k)) >= LONG_WORD).cast("int"), F.lit(0))
    hashed = F.xxhash64(run_text(F.col("words"), F.col("at"), PAIR))
    return vote(terms, key, hashed, 1 + long_word(0) + long_word(1))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return 1 - differing_bits(a, b) / F.lit(float(BITS))


def _tables(radius: int, blocks: int) -> list[list[tuple[int, int]]]:
    """Per table the (first bit, bits) of its blocks.

    ``radius`` differing bits spoil at most as many blocks, so some choice of ``blocks - radius`` blocks agrees.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("the radius must be smaller than the number of blocks")
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    spans = [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(blocks)]
    return [list(chosen) for chosen in combinations(spans, blocks - radius)]


def within_radius(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Distinct fingerprints of both sides -> (query, found, bits): all pairs of at most ``radius`` differing bits.

    One table per choice of blocks; its key is the chosen blocks moved to the front. A pair that agrees in
    several tables is reported by the first one only, so pairs are not collected to be made distinct.
    """
    tables = _tables(radius, blocks)

    def key(fingerprint: Column, table: list[tuple[int, int]]) -> Column:
        out = F.lit(0).cast("long")
        for first, n in table:
            mask = F.lit((1 << n) - 1 if n < BITS else -1)
            part = F.shiftrightunsigned(fingerprint, first).bitwiseAND(mask)
            out = F.shiftleft(out, n).bitwiseOR(part)
        return out

    def keyed(side: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(i).alias("table"), key(F.col("fingerprint"), t).alias("key")) for i, t in enumerate(tables)])
        return side.select(F.col("fingerprint").alias(name), F.explode(keys).alias("at")).select(name, "at.table", "at.key")

    pairs = keyed(queries, "query").join(keyed(index, "found"), ["table", "key"])
    pairs = pairs.where(differing_bits(F.col("query"), F.col("found")) <= radius)
    first = F.lit(None).cast("int")
    for i, t in reversed(list(enumerate(tables))):
        first = F.when(key(F.col("query"), t) == key(F.col("found"), t), F.lit(i)).otherwise(first)
    return pairs.where(F.col("table") == first).select(
        "query", "found", differing_bits(F.col("query"), F.col("found")).alias("bits")
    )


def _with_order(docs: DataFrame) -> DataFrame:
    """Rows with an id: doc_id, text, its hash, bucket. Rows of one id stand in the order of the hash."""
    text = F.coalesce("text", F.lit(""))
    return docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("mix"), F.floor(F.col("doc_id") / BUCKET_IDS).alias("bucket")
    )


def _bucket_ends(rows: DataFrame) -> DataFrame:
    """Last row of each bucket that holds rows and the first of the next one; the last bucket leads to the first.

    Made of ids and hashes alone.
    """
    here = F.struct("doc_id", "mix")
    buckets = rows.groupBy("bucket").agg(F.min(here).alias("first"), F.max(here).alias("last"), F.count(F.lit(1)).alias("n"))
    ranked = with_rank(buckets, "bucket")
    n = ranked.count()
    following = ranked.select(F.col("rank").alias("next_rank"), F.col("bucket").alias("next_bucket"), F.col("first").alias("next"))
    return ranked.withColumn("next_rank", (F.col("rank") + 1) % n).join(following, "next_rank").select(
        "bucket", F.col("n").alias("place"), "next_bucket", "last.doc_id", "last.mix", F.col("next.doc_id").alias("next_id"), F.col("next.mix").alias("next_mix")
    )


def edited_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ..) -> bucket, place, doc_id, text, edited, next_bucket, next_place, one row per row with an id.

    ``edited``: the last floor(n/4) code points of the text give way to the first as many (or all) of the text
    of the next document in the order of doc_id; the last one is followed by the first, a lone one by itself. NULL texts are empty,
    rows of one id follow each other. (bucket, place) is unique.

    Texts are shuffled once, by bucket of ids; only the ends of buckets, one in BUCKET_IDS rows where ids are dense, are joined.
    """
    rows = _with_order(docs)
    inside = Window.partitionBy("bucket").orderBy("doc_id", "mix")
    placed = rows.withColumns(
        {
            "place": F.row_number().over(inside).cast("long"),
            "next_id": F.lead("doc_id").over(inside),
            "next_text": F.lead("text").over(inside),
        }
    )
    placed = placed.where("next_id is not null").withColumns(
        {"next_bucket": F.col("bucket"), "next_place": F.col("place") + 1}
    )
    ends = written(_bucket_ends(rows.select("doc_id", "mix", "bucket")), "bucket_ends")
    wanted = ends.select("doc_id", "mix").union(ends.select("next_id", "next_mix")).distinct()
    if ends.count() <= BROADCAST_ENDS:
        wanted = F.broadcast(wanted)
    texts = rows.select("doc_id", "mix", "text").join(wanted, ["doc_id", "mix"])
    texts = written(texts.dropDuplicates(["doc_id", "mix"]), "end_texts")
    nexts = texts.select(F.col("doc_id").alias("next_id"), F.col("mix").alias("next_mix"), F.col("text").alias("next_text"))
    ends = ends.join(texts, ["doc_id", "mix"]).join(nexts, ["next_id", "next_mix"]).withColumn("next_place", F.lit(1).cast("long"))
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - length(text) div 4)"), F.col("next_text").substr(F.lit(1), quarter))
    out = ["bucket", "place", "doc_id", "text", edited.alias("edited"), "next_bucket", "next_place"]
    return placed.select(*out).unionByName(ends.select(*out))


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, their likeness, and the search for near ones.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (signed 64-bit numbers), near_edited,
    near_next, n_near (other fingerprints of the corpus within RADIUS bits). Rows without an id have
    no successor: their edited text is their text and near_next is NULL. No rows in, none out.
    """
    pairs = edited_texts(docs)
    alone = docs.where("doc_id is null").select(
        F.lit(None).cast("long").alias("bucket"),
        F.monotonically_increasing_id().alias("place"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("text", F.lit("")).alias("edited"),
        F.lit(None).cast("long").alias("next_bucket"),
        F.lit(None).cast("long").alias("next_place"),
    )
    key = ["bucket", "place", "doc_id", "next_bucket", "next_place", "n_chars", "edited_sha256", "edited"]
    both = pairs.unionByName(alone).select(
        *key[:5],
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(False).alias("edited"), "text"), F.struct(F.lit(True).alias("edited"), F.col("edited").alias("text")))).alias("one"),
    )
    prints = text_fingerprints(both.select(*key[:7], "one.edited", "one.text"), key)
    rows = written(
        prints.groupBy(*key[:7]).agg(
            F.max(F.when(~F.col("edited"), F.col("fingerprint"))).alias("fingerprint"),
            F.max(F.when(F.col("edited"), F.col("fingerprint"))).alias("edited_fingerprint"),
        ),
        "fingerprints",
    )
    distinct = rows.select("fingerprint").distinct()
    near = (
        within_radius(distinct, distinct)
        .where("query <> found")
        .groupBy(F.col("query").alias("fingerprint"))
        .agg(F.count(F.lit(1)).alias("n_near"))
    )
    following = rows.select(
        F.col("bucket").alias("next_bucket"), F.col("place").alias("next_place"), F.col("fingerprint").alias("_next")
    )
    return (
        rows.join(following, ["next_bucket", "next_place"], "left")
        .join(near, "fingerprint", "left")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        )
    )
