"""Balanced label propagation over linked documents.

Documents start in shards of equal counts, dealt by rank. In each round a document of a group looks
where most members of its groups are and asks to move there; joins and sums
of (group, shard) counts decide, quotas per pair of shards keep every shard within its capacity.
Documents without links only fill what room is left, so counts end at most one apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreworks.llm.common import with_rank, written

SHARDS = 8
ROUNDS = 6
# Members of a group meet their group's counts in so many parts, so that a hot group is no hot key.
SALTS = 64
# Movers of a pair of shards are admitted by whole steps of this many parts.
STEPS = 1024


def capacities(n: int, shards: int) -> list[int]:
    """Counts at most one apart that add up to n."""
    return [(n + shards - 1 - s) // shards for s in range(shards)]


def _to_members(members: DataFrame, of_group: DataFrame) -> DataFrame:
    """Values per group joined to the members (id, group, salt, ..); at most SALTS rows of a group meet by group alone."""
    salted = members.select("group", "salt").distinct().join(of_group, "group")
    return members.join(salted, ["group", "salt"])


def _wishes(members: DataFrame, state: DataFrame, shards: int) -> DataFrame:
    """(id, shard, wish, first, members): the shard that holds most of the members of the document's groups, itself counted once.

    Ties go round from a shard that the smallest group's hash names, so members of a group agree.
    """
    placed = members.join(state, "id")
    counts = placed.groupBy("group").agg(
        *[F.count_if(F.col("shard") == s).alias(f"c{s}") for s in range(shards)], F.count(F.lit(1)).alias("_all")
    )
    votes = (
        _to_members(placed, counts)
        .groupBy("id", "shard")
        .agg(
            F.count(F.lit(1)).alias("groups"),
            *[F.sum(f"c{s}").alias(f"c{s}") for s in range(shards)],
            F.min(F.xxhash64("group")).alias("first"),
            F.max("_all").alias("_all"),
        )
    )
    ranked = [
        F.struct(
            (F.col(f"c{s}") - F.when(F.col("shard") == s, F.col("groups") - 1).otherwise(0)).alias("votes"),
            F.pmod(F.lit(s) - F.pmod("first", F.lit(shards)), F.lit(shards)).alias("turn"),
            F.lit(s).alias("shard"),
        )
        for s in range(shards)
    ]
    best = F.greatest(*ranked)["shard"].cast("int")
    return votes.select("id", "shard", best.alias("wish"), "first", F.col("_all").alias("members"))


def _admitted(wishes: DataFrame, room: list[int], shards: int) -> DataFrame:
    """(from, to, step) of the movers let in: per target as much as its room and those who leave for it in exchange.

    Groups move whole, except those too large for a step, whose members are dealt over the steps.
    """
    moves = wishes.where("wish <> shard")
    per_pair = {(r[0], r[1]): r[2] for r in moves.groupBy("shard", "wish").count().collect()}  # shards squared
    quota = {pair: min(n, per_pair.get(pair[::-1], 0)) for pair, n in per_pair.items()}
    for to in range(shards):
        left = max(0, room[to])
        over = {pair: n - quota[pair] for pair, n in per_pair.items() if pair[1] == to}
        for pair, n in sorted(over.items(), key=lambda x: (x[1], x[0])):
            share = min(n, left)
            quota[pair] += share
            left -= share
    spark = wishes.sparkSession
    table = spark.createDataFrame(
        [(a, b, n) for (a, b), n in quota.items() if n], "shard int, wish int, quota long"
    )
    steps = moves.groupBy("shard", "wish", "step").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(_by_step())  # at most shards squared x STEPS rows
    return (
        steps.withColumn("upto", before)
        .join(F.broadcast(table), ["shard", "wish"])
        .where("upto <= quota")
        .select("shard", "wish", "step")
    )


def _by_step():
    return Window.partitionBy("shard", "wish").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)


def propagate(members: DataFrame, state: DataFrame, capacity: list[int], rounds: int = ROUNDS) -> DataFrame:
    """members (id, group, salt), state (id, shard) of all linked ids -> state after at most ``rounds`` rounds.

    No shard ever holds more linked ids than its capacity, if it did not at the start. Each round is written.
    """
    shards = len(capacity)
    linked = state.count()
    whole = max(1, linked // (shards * STEPS))
    for _ in range(rounds):
        held = {r[0]: r[1] for r in state.groupBy("shard").count().collect()}
        wishes = _wishes(members, state, shards)
        dealt = F.when(F.col("members") > whole, F.xxhash64("id")).otherwise(F.col("first"))
        wishes = written(wishes.withColumn("step", F.pmod(dealt, F.lit(STEPS)).cast("int")), "wishes")
        admitted = _admitted(wishes, [capacity[s] - held.get(s, 0) for s in range(shards)], shards)
        admitted = F.broadcast(admitted.withColumn("_in", F.lit(True)))  # at most shards squared x STEPS rows
        moved = wishes.join(admitted, ["shard", "wish", "step"], "left")
        state = written(
            moved.select("id", F.when(F.col("_in"), F.col("wish")).otherwise(F.col("shard")).alias("shard"), F.coalesce("_in", F.lit(False)).alias("moved")),
            "state",
        )
        n_moved = state.where("moved").count()
        state = state.drop("moved")
        if not n_moved:
            break
    return state


def cut_edges(members: DataFrame, state: DataFrame) -> DataFrame:
    """One row: linked (group, id) memberships, and those outside their group's largest shard."""
    counts = members.join(state, "id").groupBy("group", "shard").count()
    groups = counts.groupBy("group").agg(F.sum("count").alias("n"), F.max("count").alias("most"))
    return groups.agg(F.sum("n").alias("memberships"), F.sum(F.col("n") - F.col("most")).alias("cut"))


def _by_room(place: str, room: list[int], taken: list[int]):
    """Place among the unlinked -> (shard, slot): shards are filled up one after the other, after the slots taken."""
    starts = [sum(room[:s]) for s in range(len(room))]
    at = F.col(place)
    shard, slot = F.lit(None).cast("int"), F.lit(None).cast("long")
    for s, n in reversed(list(enumerate(room))):
        inside = (at >= starts[s]) & (at < starts[s] + n)
        shard, slot = F.when(inside, F.lit(s)).otherwise(shard), F.when(inside, at - starts[s] + taken[s]).otherwise(slot)
    return shard, slot


def balanced_shards(nodes: DataFrame, members: DataFrame, shards: int = SHARDS) -> DataFrame:
    """nodes (id 0..n-1, ..), members (id, group) -> nodes with shard and slot; counts at most one apart.

    Groups of one id and repeated memberships are no links. NULL groups link nothing. Slots are gapless from 0 in
    each shard. An empty table gives an empty one.
    """
    n = nodes.count()
    capacity = capacities(n, shards)
    members = members.where(F.col("group").isNotNull()).select("id", "group").distinct()
    members = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    parts = members.groupBy("group", "salt").agg(F.count(F.lit(1)).alias("n"))
    linked_groups = parts.groupBy("group").agg(F.sum("n").alias("n")).where("n > 1").select("group")
    members = written(_to_members(members, linked_groups).select("id", "group", "salt"), "members")
    linked = members.groupBy("id").agg(F.min("group").alias("group"))
    start = written(linked.select("id", "group", (F.col("id") % shards).cast("int").alias("shard")), "start")
    state = propagate(members, start.select("id", "shard"), capacity)

    # Linked ids first, then the others: the slots of a shard.
    of_linked = with_rank(state.join(start.select("id", "group"), "id"), "shard", "group", "id")
    held = {r[0]: (r[1], r[2]) for r in of_linked.groupBy("shard").agg(F.count(F.lit(1)), F.min("rank")).collect()}
    firsts = reduce(
        lambda rest, s: F.when(F.col("shard") == s, F.lit(held[s][1])).otherwise(rest), held, F.lit(0).cast("long")
    )
    counts = [held.get(s, (0, 0))[0] for s in range(shards)]
    room = [capacity[s] - counts[s] for s in range(shards)]
    placed = of_linked.select("id", "shard", (F.col("rank") - firsts).alias("slot"))
    unlinked = with_rank(nodes.select("id").join(start.select("id"), "id", "left_anti"), "id", rank="place")
    shard, slot = _by_room("place", room, counts)
    rest = unlinked.select("id", shard.alias("shard"), slot.alias("slot"))
    return nodes.join(placed.unionByName(rest), "id")


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, text, ..) -> doc_id, size, text_crc32, law, shard, slot, grown_shard, group_id: equal texts are linked.

    A NULL text has no bytes, and NULL texts are equal to each other and to no other text. Repeated rows and ids are
    documents of their own. The law is ``rows``: counts of shards differ by one at most.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("none")).alias("group"),
    )
    # Ids in the order of a hash, so that shards start without regard to groups or sources.
    rows = rows.withColumn("_mix", F.xxhash64("doc_id", "group"))
    nodes = with_rank(rows, "_mix", "doc_id", "group", rank="id").drop("_mix")
    placed = balanced_shards(nodes, nodes.select("id", "group"), shards)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("group").alias("group_id"),
    )
