from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from oreworks.llm import prefix_trie

from ..oracle_compare import connect, duck_rows, spark_rows

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """Per conversation its turns, each in order, after the heads have been exchanged."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            turns[conv].append(((turn is not None, turn or 0, role, digest), (role, text)))
    turns = {c: [t for _, t in sorted(x)] for c, x in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def trie_rows(whole):
    """One set of members per prefix, prefixes compared as they are."""
    members = defaultdict(set)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, own in members.items():
        n_bytes = len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own) - 1) * n_bytes
    out = []
    for p, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(whole[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(own), len(p), parent, len(own), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in prefix_trie.trie_digest(df).collect()]
    assert sorted(got, key=repr) == trie_rows(rebuilt(rows))


def test_against_sql(spark, sf_dir):
    got = prefix_trie.trie_digest(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    assert spark_rows(got) == duck_rows(connect(sf_dir), prefix_trie.oracle_sql())


@pytest.mark.parametrize("seed", range(2))
def test_random_conversations(spark, seed):
    """Few texts, so that conversations share prefixes of all lengths, across several levels of blocks."""
    rnd = random.Random(seed)
    rows = []
    for conv in rnd.sample(range(-20, 300), 120):
        stem = rnd.choice(["a", "b", "long"])
        n = rnd.choice([1, 2, 4, 7, 8, 9, 17]) if stem != "long" else rnd.choice([64, 65, 90])
        for t in range(n):
            text = f"{stem}{t}" if rnd.random() < 0.95 else rnd.choice(["x", "é", "", None])
            rows.append((conv, t, rnd.choice(["user"] * 9 + [None]), text))
    check(spark, rows)


def test_nulls_ties_repeats_and_moved_borders(spark):
    rows = [
        (1, None, "user", "first"),
        (1, 0, "user", "second"),
        (1, 0, "user", "second"),
        (1, 0, "assistant", "second"),
        (2, 5, None, None),
        (3, -1, "us", "er"),
        (3, 7, "use", "r"),
        (None, 0, "user", "nobody's"),
        (-7, 0, "user", "x" * 100_000),
        (10, 0, "user", "0:"),
        (11, 0, "", "user"),
        *[(20 + k, 0, "user", "same") for k in range(12)],
    ]
    check(spark, rows)


def test_one_conversation_has_most_rows_and_one_group_most_conversations(spark):
    rows = [(0, t, "user", f"turn {t % 7}") for t in range(1500)]
    rows += [(100 + k, t, "user", f"hot {t}") for k in range(2500) for t in range(2)]
    check(spark, rows)


def test_other_blocks_give_the_same_trie(spark, sf_dir, block=3):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns, convs = prefix_trie.rebuilt_turns(prefix_trie.turn_digests(table))
    columns = ["depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    other = prefix_trie.prefix_trie(turns, convs, block).nodes.select(columns).collect()
    assert sorted(other) == sorted(prefix_trie.prefix_trie(turns, convs).nodes.select(columns).collect())


def test_empty_and_clashing_columns(spark):
    rows = [(1, 0, "user", "a"), (6, 0, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.selectExpr("*", "1 AS key", "2 AS pos", "3 AS rank", "'x' AS digest", "4 AS n_bytes")
    assert sorted(map(tuple, prefix_trie.trie_digest(extra).collect()), key=repr) == trie_rows(rebuilt(rows))
    assert prefix_trie.trie_digest(df.where("conv_id < 0")).count() == 0
    assert prefix_trie.trie_digest(df.selectExpr("cast(null as long) AS conv_id", "turn", "role", "text")).count() == 0
