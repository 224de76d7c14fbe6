from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from oreworks.functions.draws import draw
from oreworks.operators import datagen


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(("n", "rate", "k"), [(100, 0.2, 20), (10000, 0.15, 1000)])
def test_sampled_duplicates(spark, n, rate, k):
    got = rows(datagen.people_with_sampled_duplicates(spark.range(1, n + 1), rate, k))
    counts = Counter(got)
    assert len(got) == n + k and len(counts) == n
    assert sorted(counts.values())[-k:] == [2] * k
    assert {r[0] for r in got} == set(range(1, n + 1))
    assert {r[1] for r in got} == set(datagen.NAMES)
    ages = [r[2] for r in counts]
    assert abs(sum(a is None for a in ages) / n - rate) < 0.1
    assert all(18 <= a <= 80 for a in ages if a is not None)
    # Not in id order, and the same for any partitioning.
    assert [r[0] for r in got] != sorted(r[0] for r in got)
    again = datagen.people_with_sampled_duplicates(spark.range(1, n + 1).repartition(3), rate, k)
    assert rows(again) == got


@pytest.mark.parametrize("k", [0, 1, 7, 999, 1000, 5000])
def test_sample_is_exact(spark, k):
    ids = spark.range(1000)
    rank = draw(F.col("id"), "sample", 3)
    got = sorted(r.id for r in datagen.sample_exactly(ids, k, rank).collect())
    want = sorted(r.id for r in ids.orderBy(rank, "id").limit(k).collect())
    assert got == want


def test_inline_duplicates_are_adjacent(spark):
    got = rows(datagen.people_with_inline_duplicates(spark.range(1, 1501), 0.1))
    assert [r[0] for r in got] == sorted(r[0] for r in got)
    assert len(set(got)) == 1500
    assert 1500 + 30 < len(got) < 1500 + 130


def test_reused_ids_differ_in_content(spark):
    got = rows(datagen.people_with_reused_ids(spark.range(1, 2001), 0.05, 200))
    assert len(got) == 2200
    assert len({r[0] for r in got}) == 2000
    assert len(set(got)) > 2150
