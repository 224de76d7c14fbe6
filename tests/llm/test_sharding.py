from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from oreworks.llm import sharding

from .conftest import documents


def check_law(rows, shards=8):
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
    sizes = [len(by_shard[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))


def cut(rows):
    """Members outside their group's largest shard."""
    groups = defaultdict(Counter)
    for r in rows:
        groups[r.group_id][r.shard] += 1
    return sum(sum(c.values()) - max(c.values()) for c in groups.values())


def test_documents(spark, sf_dir):
    docs = documents(spark, sf_dir)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sharding.shard_documents(spark, docs).collect()
    check_law(rows)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    assert cut(rows) == 0


def test_hot_group_is_split_and_small_ones_stay_whole(spark):
    """A third of all rows is one group; another hundred groups have four members each."""
    docs = spark.range(2400).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 800, "hot").when(F.col("id") < 1200, F.concat(F.lit("g"), F.col("id") % 100)).otherwise(F.concat(F.lit("own"), "id")).alias("text"),
    )
    rows = sharding.shard_documents(spark, docs).collect()
    check_law(rows)
    hot = zlib.crc32(b"hot")
    held = Counter(r.shard for r in rows if r.text_crc32 == hot)
    assert sum(held.values()) == 800 and 240 <= max(held.values()) <= 300
    others = [r for r in rows if r.text_crc32 != hot]
    # At random a group of four would leave more than half of its members outside its largest shard.
    assert cut(others) <= 40


def test_links_of_several_groups(spark):
    """Edges as groups of two, spread over all shards at the start; a quarter of the nodes has links."""
    nodes = spark.range(256).select("id")
    edges = [(f"{c}-{a}-{b}", c * 8 + a, c * 8 + b) for c in range(8) for a in range(8) for b in range(a)]
    members = spark.createDataFrame([(x, g) for g, a, b in edges for x in (a, b)], "id long, group string")
    rows = sharding.balanced_shards(nodes, members).collect()
    check_law(rows)
    where = {r.id: r.shard for r in rows}
    assert sum(where[a] != where[b] for _, a, b in edges) < 0.75 * len(edges)


def test_awkward_rows(spark, awkward, no_docs):
    rows = sharding.shard_documents(spark, awkward).collect()
    check_law(rows)
    assert len(rows) == 12
    assert sorted(r.size for r in rows if r.doc_id in (2, 3)) == [1, 1]
    assert sharding.shard_documents(spark, no_docs).count() == 0
    assert sharding.capacities(10, 4) == [3, 3, 2, 2]


def test_cut_is_counted(spark):
    members = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, "b")], "id long, group string")
    state = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 2), (5, 2)], "id long, shard int")
    assert tuple(sharding.cut_edges(members, state).first()) == (5, 1)
