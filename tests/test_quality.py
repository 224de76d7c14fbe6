from __future__ import annotations

from datetime import datetime, timezone

import pytest

from oreworks.operators import quality
from oreworks.plans.medallion import check_quality
from oreworks.sources.rowlog import read_rows
from oreworks.spec import PEOPLE

SCHEMA = "id int, name string, age int"
NAMES = quality.metric_names(PEOPLE)


def measured(df):
    row = quality.quality_metrics(df, PEOPLE).first()
    return [row[n] for n in NAMES]


def test_counts_and_null_ages_match_no_rule(spark):
    df = spark.createDataFrame(
        [(1, "a", -1), (1, "b", 121), (None, "c", None), (None, "d", 120), (2, "e", 0)], SCHEMA
    )
    assert measured(df) == [5, 2, 1, 1, 2]


def test_empty_table_counts_zero_and_passes(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert measured(df) == [0, 0, 0, 0, 0]
    assert quality.gate(quality.quality_metrics(df, PEOPLE), PEOPLE).first()["passed"]


@pytest.mark.parametrize(("nulls", "keys", "passes"), [(0, 4, True), (2, 2, True), (3, 2, False), (4, 0, False)])
def test_gate_boundary(spark, layout, nulls, keys, passes):
    data = [(None, "n", 1)] * nulls + [(i, "k", 1) for i in range(keys)]
    df = spark.createDataFrame(data, SCHEMA)
    ok, metrics = check_quality(spark, df, PEOPLE, layout)
    assert ok is passes
    assert metrics["null_ids"] == nulls
    # The metrics row is there whether the gate passes or not.
    assert read_rows(spark, layout.dq_metrics, quality.metrics_schema(PEOPLE)).count() == 1


def test_empty_table_leaves_no_metrics_row(spark, layout):
    ok, _ = check_quality(spark, spark.createDataFrame([], SCHEMA), PEOPLE, layout)
    assert ok
    assert read_rows(spark, layout.dq_metrics, quality.metrics_schema(PEOPLE)) is None


def test_latest_and_breakdown(spark, layout):
    early = spark.createDataFrame([(1, "a", -1)], SCHEMA)
    late = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (None, "b", 200)], SCHEMA)
    check_quality(spark, late, PEOPLE, layout, datetime(2024, 1, 2, tzinfo=timezone.utc))
    check_quality(spark, early, PEOPLE, layout, datetime(2024, 1, 1, tzinfo=timezone.utc))
    log = read_rows(spark, layout.dq_metrics, quality.metrics_schema(PEOPLE))
    latest = quality.latest_metrics(log)
    assert latest.first()["total_rows"] == 3
    breakdown = {r.violation: r.violations for r in quality.violation_breakdown(latest, PEOPLE).collect()}
    assert breakdown == {"Null IDs": 1, "Neg. Ages": 0, "Inv. Ages": 1, "Duplicates": 1}


def test_same_record_is_not_doubled(spark, layout):
    df = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    for _ in range(2):
        check_quality(spark, df, PEOPLE, layout, record_id="batch_7")
    assert read_rows(spark, layout.dq_metrics, quality.metrics_schema(PEOPLE)).count() == 1
