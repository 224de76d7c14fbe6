"""Prefix trie of conversations by hashing blocks of turns of fixed length.

Turns are summed up in blocks of BLOCK turns, whole blocks in blocks of blocks, and so on, so that a conversation of n turns has
log n levels and no row ever holds more than BLOCK digests, however long the conversation. From the top level down each prefix that
ends with a block gets a key, made of the key of its enclosing block's beginning and the digests since. Conversations are grouped by these keys first: equal
blocks after equal prefixes become one row with a count. Only where blocks with the same beginning differ are the boundaries of
single turns hashed and grouped; a block without siblings is laid out as it stands.

Sums over subtrees go the same way: a node adds itself to its ancestors inside its block, whole blocks are summed up as nodes of the next
level, and what the next level finds below a block's last turn is added there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.common import with_rank, written

BLOCK = 4
# Ids of one chunk of a node's list of ends.
CHUNK_IDS = 1024


class Trie(NamedTuple):
    """nodes: key, conv_id (smallest member), depth, parent (key; NULL for the root), n_convs, n_bytes (of the last text), n_children,
    n_leaves, saved_tokens. ends: key, conv_id of every conversation, at its last turn."""

    nodes: DataFrame
    ends: DataFrame


def _hashed(*parts: Column) -> Column:
    """128 bits of SHA-256, over binary parts."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


# The key of the empty prefix.
ROOT = bytes(16)


def turn_digests(turns: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(conv_id, turn, role, text, ..) -> conv_id, pos, digest, n_bytes: turns in order, from 0.

    NULL turns come first; equal turns are ordered by role and then by the digest of role and text, repeated rows stay. NULL roles
    and texts are empty. Rows without a conversation are no turns of any and go. The role's length stands before it, so
    that no role and text pass for others.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = _hashed(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    plain = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    # Written first: ranking samples its input, which would hash every text twice.
    ranked = with_rank(written(plain, "turns"), "conv_id", "turn", "role", "digest", "n_bytes", rank="rank")
    firsts = ranked.groupBy("conv_id").agg(F.min("rank").alias("first"))
    placed = ranked.join(firsts, "conv_id").select("conv_id", (F.col("rank") - F.col("first")).alias("pos"), "digest", "n_bytes")
    return written(placed, "placed_turns")


# -- keys --------------------------------------------------------------------------


def _blocks(units: DataFrame, block: int) -> DataFrame:
    """conv_id, q, digests (in order, ``block`` at most), n_bytes of those units."""
    unit = F.struct("pos", "digest", "n_bytes")
    grouped = units.groupBy("conv_id", F.expr(f"pos div {block}").alias("q")).agg(F.array_sort(F.collect_list(unit)).alias("u"))
    return grouped.select("conv_id", "q", F.col("u.digest").alias("digests"), F.col("u.n_bytes").alias("n_bytes"))


def _whole_blocks(blocks: DataFrame, block: int) -> DataFrame:
    """Blocks without a gap as units of the next level."""
    digest = F.aggregate("digests", F.unhex(F.lit("")), lambda acc, x: F.concat(acc, x))
    whole = blocks.where(F.size("digests") == block)
    return whole.select("conv_id", F.col("q").alias("pos"), _hashed(digest).alias("digest"), F.lit(0).cast("long").alias("n_bytes"))


def _with_paths(blocks: DataFrame, above: DataFrame | None, block: int) -> DataFrame:
    """Adds top (the key before the block) and path (the keys after each of its units).

    above: conv_id, pos (units of the next level up to there), key.
    """
    if above is None:
        rows = blocks.withColumn("top", F.lit(ROOT)).withColumn("last", F.lit(None).cast("binary"))
    else:
        rows = blocks.join(above.select("conv_id", F.col("pos").alias("q"), F.col("key").alias("top")), ["conv_id", "q"], "left")
        rows = rows.join(above.select("conv_id", (F.col("pos") - 1).alias("q"), F.col("key").alias("last")), ["conv_id", "q"], "left")
        rows = rows.withColumn("top", F.coalesce("top", F.lit(ROOT)))
    chain = F.aggregate("digests", F.array("top"), lambda acc, x: F.concat(acc, F.array(_hashed(F.element_at(acc, -1), x))))
    path = F.slice(chain, 2, block)
    # A prefix that ends with a whole block has one key on all levels.
    return rows.withColumn("path", F.when(F.col("last").isNull(), path).otherwise(F.concat(F.slice(path, 1, block - 1), F.array("last")))).drop("last")


def _keyed_levels(turns: DataFrame, block: int) -> list[DataFrame]:
    """Per level, from the turns up: conv_id, q, digests, n_bytes, top, path."""
    blocks = [written(_blocks(turns, block), "blocks")]
    while not (units := _whole_blocks(blocks[-1], block)).isEmpty():
        blocks.append(written(_blocks(units, block), "blocks"))
    levels, above = [], None
    for rows in reversed(blocks):
        keyed = written(_with_paths(rows, above, block), "paths")
        levels.append(keyed)
        above = keyed.select("conv_id", F.posexplode("path").alias("i", "key"), "q").select("conv_id", (F.col("q") * block + F.col("i") + 1).alias("pos"), "key")
    return levels[::-1]


# -- nodes -------------------------------------------------------------------------


def _turn_nodes(level: DataFrame, block: int) -> DataFrame:
    """key, top, path (keys of the block up to the node), depth, conv_id, n_convs, n_bytes: a row per distinct prefix."""
    alike = level.groupBy("top", F.element_at("path", -1).alias("end"), F.size("path").alias("size")).agg(
        F.first("q").alias("q"), F.first("path").alias("path"), F.first("n_bytes").alias("bytes"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")
    )
    siblings = alike.groupBy("top").agg(F.count(F.lit(1)).alias("siblings"))
    # A beginning that a third of all conversations share is a hot key here; adaptive execution splits it, as its other side is one row.
    alike = alike.join(siblings, "top")
    turn = F.posexplode("path").alias("i", "key")
    laid = alike.select("top", "path", "bytes", "q", "conv_id", "n_convs", "siblings", turn).select(
        "key",
        "top",
        F.slice("path", F.lit(1), F.col("i") + 1).alias("path"),
        (F.col("q") * block + F.col("i") + 1).alias("depth"),
        "conv_id",
        "n_convs",
        F.element_at("bytes", F.col("i") + 1).alias("n_bytes"),
        "siblings",
    )
    laid = written(laid, "block_turns")
    others = ["top", "path", "depth", "n_bytes"]
    split = laid.where("siblings > 1").groupBy("key").agg(
        *[F.first(c).alias(c) for c in others], F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs")
    )
    names = ["key", *others, "conv_id", "n_convs"]
    return laid.where("siblings = 1").select(names).unionByName(split.select(names))


def _block_nodes(level: DataFrame) -> DataFrame:
    """key, top, path of the distinct prefixes of a level above the turns."""
    rows = level.select("top", "path", F.posexplode("path").alias("i", "key")).select("key", "top", F.slice("path", F.lit(1), F.col("i") + 1).alias("path"))
    return rows.groupBy("key").agg(F.first("top").alias("top"), F.first("path").alias("path"))


def _subtree_sums(levels: list[DataFrame], weights: DataFrame, sums: list[str]) -> DataFrame:
    """key and the sums of its subtree, itself included, for all nodes of the first level but the root.

    levels: nodes (key, top, path) from the turns up. weights: key and own amounts.
    """
    own = levels[0].select("key", "top", "path").join(weights, "key", "left").fillna(0, sums)
    if len(levels) > 1:
        own = written(own, "weights")
        up = own.groupBy(F.col("top").alias("key")).agg(*[F.sum(c).alias(c) for c in sums])
        below = _subtree_sums(levels[1:], up, sums)
        own = own.join(below.toDF("key", *[f"below_{c}" for c in sums]), "key", "left")
        own = own.select("path", *[(F.col(c) + F.coalesce(f"below_{c}", F.lit(0))).alias(c) for c in sums])
    return own.select(F.explode("path").alias("key"), *sums).groupBy("key").agg(*[F.sum(c).alias(c) for c in sums])


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, block: int = BLOCK) -> Trie:
    """The trie of all conversations; see Trie.

    turns: conv_id, pos (from 0, gapless), digest (binary), n_bytes, as ``turn_digests`` gives them. conversations: conv_id, with those
    without a turn, which end at the root; those of the turns if not given. n_leaves counts the childless nodes of a node's subtree, itself
    included; saved_tokens sums over its subtree (n_convs - 1) x n_bytes, what need not be computed again. No conversations, no nodes.
    Repeated conversations are members of the same nodes, NULL ids are to be left out before.
    """
    levels = _keyed_levels(turns, block)
    nodes = written(_turn_nodes(levels[0], block), "trie_nodes")
    before = F.when(F.size("path") > 1, F.element_at("path", F.size("path") - 1)).otherwise(F.col("top"))
    nodes = nodes.withColumn("parent", before)

    # The end of a conversation is the last key of its last block.
    last = levels[0].groupBy("conv_id").agg(F.max_by(F.element_at("path", -1), "q").alias("key"))
    ends = last.select("key", "conv_id")
    if conversations is not None:
        everyone = conversations.select("conv_id").distinct()
        ends = everyone.join(last, "conv_id", "left").select(F.coalesce("key", F.lit(ROOT)).alias("key"), "conv_id")
    ends = written(ends, "trie_ends")
    root = ends.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("n_bytes"), "conv_id", "n_convs", F.lit(None).cast("binary").alias("parent"))

    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "key", "left").fillna(0, ["n_children"])
    saved = (F.col("n_convs") - 1) * F.col("n_bytes")
    weights = counted.select("key", (F.col("n_children") == 0).cast("long").alias("n_leaves"), saved.alias("saved_tokens"))
    sums = ["n_leaves", "saved_tokens"]
    below = written(_subtree_sums([nodes, *map(_block_nodes, levels[1:])], weights, sums), "subtrees")
    # The root's subtree is that of its children.
    tops = nodes.where(F.col("parent") == F.lit(ROOT)).select("key").join(below, "key").agg(F.lit(1).alias("one"), *[F.sum(c).alias(c) for c in sums])
    whole = tops.select(F.lit(ROOT).alias("key"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"))
    columns = ["key", "depth", "n_bytes", "conv_id", "n_convs", "parent"]
    every = nodes.select(columns).unionByName(root)
    full = every.join(children, "key", "left").join(below.unionByName(whole.select(below.columns)), "key").fillna(0, ["n_children"])
    return Trie(written(full, "trie"), ends)


# -- digests -----------------------------------------------------------------------


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) -> key, first, ids: decimal ids joined by commas, CHUNK_IDS in a row at most."""
    key, ids = None, []

    def chunk() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["key", "first", "ids"])

    for batch in batches:
        for k, i in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if ids and (k != key or len(ids) == CHUNK_IDS):
                yield chunk()
                ids = []
            key = k
            ids.append(i)
    if ids:
        yield chunk()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by (key, first) -> key, ends_sha256 of the whole list, read once."""
    key, running = None, None
    for batch in batches:
        keys, sums = [], []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if running is not None and k == key:
                running.update(b"," + ids.encode())
                continue
            if running is not None:
                keys.append(key)
                sums.append(running.hexdigest())
            key, running = k, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sums, pa.string())], ["key", "ends_sha256"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()])], ["key", "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """key, ends_sha256: SHA-256 of the node's conv_ids, ascending and joined by commas.

    Ranges of (key, conv_id) write the ids down in chunks, so a node with many ends is spread over tasks; the hash itself is sequential
    and reads the chunks of a node one after the other, holding one.
    """
    chunks = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = chunks.mapInArrow(_chunked, "key binary, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digested, "key binary, ends_sha256 string")


def rebuilt_turns(turns: DataFrame, group: int = 5, modulus: int = 9) -> tuple[DataFrame, DataFrame]:
    """Placed turns -> (rebuilt turns, conversations).

    Conversation c begins with the first h turns of conversation c - c % group, h = crc32 of its decimal id modulo ``modulus``, and goes on
    with its own turns after its first h. The remainder of a negative id is negative, as SQL has it.
    """
    n_turns = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus).alias("h")
    convs = n_turns.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), head)
    given = n_turns.select(F.col("conv_id").alias("base"), F.col("n").alias("given"))
    convs = written(convs.join(given, "base", "left").withColumn("given", F.least("h", F.coalesce("given", F.lit(0)))), "rebuilt")
    # At most modulus - 1 turns of a conversation go to at most ``group`` others (twice that around 0).
    heads = turns.where(F.col("pos") < modulus - 1).withColumnRenamed("conv_id", "base").join(convs, "base").where("pos < h")
    tails = turns.join(convs, "conv_id").where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("given"))
    columns = ["conv_id", "pos", "digest", "n_bytes"]
    return written(heads.select(columns).unionByName(tails.select(columns)), "rebuilt_turns"), convs.select("conv_id")


def trie_digest(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, a row per node; a parent is named by its smallest member."""
    turns, convs = rebuilt_turns(turn_digests(conversations))
    trie = prefix_trie(turns, convs)
    digests = ends_digest(trie.ends)
    # Many children of one parent are a hot key; adaptive execution splits them, as the parent is one row.
    parents = trie.nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = trie.nodes.join(digests, "key", "left").join(parents, "parent", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return named.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")
    )


def oracle_sql() -> str:
    """The same rows by lists of turns, for DuckDB; every prefix is a list of its own and subtrees are found by comparing them."""
    return """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
         {'r': coalesce(role, ''), 't': coalesce(text, '')} AS u
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY ALL),
crc AS (
  SELECT conv_id, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS c
  FROM sizes
), heads AS (SELECT conv_id, xor(c, 4294967295) % 9 AS h, conv_id - conv_id % 5 AS base FROM crc),
rebuilt AS (
  SELECT h.conv_id, t.pos AS at, t.u FROM heads h JOIN turns t ON t.conv_id = h.base AND t.pos < h.h
  UNION ALL
  SELECT h.conv_id, t.pos + 100 AS at, t.u FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.pos >= h.h
), whole AS (
  SELECT h.conv_id, coalesce(list(r.u ORDER BY r.at) FILTER (r.at IS NOT NULL), []) AS us
  FROM heads h LEFT JOIN rebuilt r ON r.conv_id = h.conv_id GROUP BY ALL
), nodes AS (
  SELECT us[1:d] AS us, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(octet_length(encode(us[1:d][d].t)), 0) AS n_bytes,
         string_agg(conv_id, ',' ORDER BY conv_id) FILTER (len(w.us) = d) AS ids
  FROM whole w, unnest(range(len(w.us) + 1)) AS depths(d) GROUP BY us[1:d], d
), children AS (SELECT us[1:d - 1] AS us, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.d = n.d AND c.us = n.us),
subtrees AS (
  SELECT a.us, a.d, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.n_bytes) AS saved
  FROM nodes a JOIN full_nodes b ON b.d >= a.d AND b.us[1:a.d] = a.us GROUP BY a.us, a.d
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ids, '')) AS ends_sha256
FROM full_nodes n JOIN subtrees s ON s.d = n.d AND s.us = n.us
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.us = n.us[1:n.d - 1]
"""
