from __future__ import annotations

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from oreworks.llm import common, near_dedup

from .conftest import documents


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(ids, prints):
    """Smallest id reachable over links of at most three bits; None ids link but name nothing."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    names = {}
    for i, doc in enumerate(ids):
        known = [x for x in (names.get(find(i)), doc) if x is not None]
        names[find(i)] = min(known, default=None)
    return [names[find(i)] for i in range(len(ids))]


def same(got, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    prints = [fingerprint(t) for _, t in rows]
    groups = brute_components([i for i, _ in rows], prints)
    want = [(i, f"{p:016x}", g) for (i, _), p, g in zip(rows, prints, groups, strict=True)]
    return sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_whole_table_against_brute_force(spark, sf_dir):
    docs = documents(spark, sf_dir)
    assert same(near_dedup.near_duplicate_groups(docs), docs)


def test_awkward_rows(awkward, no_docs):
    assert same(near_dedup.near_duplicate_groups(awkward), awkward)
    assert near_dedup.near_duplicate_groups(no_docs).count() == 0


def test_near_fingerprints_meet_at_an_anchor():
    rnd = random.Random(3)
    for _ in range(300):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), rnd.randint(0, 3)):
            b ^= 1 << bit
        homes, copies = near_dedup.anchors_of(np.array([a, b], dtype=np.uint64).view(np.int64))
        assert set(homes[0]) & set(copies[1]) and set(homes[1]) & set(copies[0])
        assert set(homes[0]) <= set(copies[0])


def test_every_word_has_one_anchor_within_the_radius():
    for code, n in ((near_dedup.GOLAY, 2000), (near_dedup.HAMMING, 128)):
        values = np.arange(n, dtype=np.int64) * 4099 % (1 << code[0])
        home, _ = near_dedup._block_anchors(values, code)
        assert max(int(x).bit_count() for x in home ^ values) <= code[1]
        assert len(set(near_dedup._block_anchors(home, code)[0] ^ home)) == 1


def test_pairs_against_brute_force(spark):
    rnd = random.Random(5)
    prints = {0, -1}
    for _ in range(40):
        centre = rnd.getrandbits(64)
        for _ in range(6):
            f = centre
            for bit in rnd.sample(range(64), rnd.randint(0, 3)):
                f ^= 1 << bit
            prints.add(f - (1 << 64) if f >> 63 else f)
    df = spark.createDataFrame([(f,) for f in prints], "fingerprint long")
    mask = (1 << 64) - 1
    want = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & mask).bit_count() <= 3}
    got = [tuple(r) for r in near_dedup.near_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    odd = [(-5, -7), (-7, -7), (-5, -7)]
    got = {r.node: r.root for r in common.connected_components(spark.createDataFrame(chain + star + odd, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 200)}, -5: -7}
    assert common.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_one_of_each_group_stays(spark, sf_dir, awkward):
    docs = documents(spark, sf_dir).withColumn("component_id", F.lit("mine"))
    kept = near_dedup.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    groups = near_dedup.near_duplicate_groups(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.component_id for r in groups.select("component_id").distinct().collect())
    # Equal rows of an id are one; blank texts are one group; rows without an id stay.
    assert sorted((r.doc_id for r in near_dedup.keep_one_per_group(awkward).collect()), key=repr) == sorted([-9, 1, 2, 6, 7, 8, None, None], key=repr)


def test_ranks_are_gapless_over_partitions(spark):
    df = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(7)).alias("k"), "id")
    rows = common.with_rank(df, "k", "id").orderBy("rank").collect()
    assert [r.rank for r in rows] == list(range(5000))
    assert [(r.k, r.id) for r in rows] == sorted((r.k, r.id) for r in rows)
    assert common.with_rank(df.where("false"), "k", "id").count() == 0
