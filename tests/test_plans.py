"""Physical plans the operators are meant to get."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from oreworks.operators import marts, quality
from oreworks.plans import catalog
from oreworks.plans.medallion import silver_rows
from oreworks.sources.versioned import VersionedTable
from oreworks.spec import PEOPLE

from .conftest import plan_of


@pytest.fixture
def bronze(spark, sf_dir, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "bronze"))
    table.overwrite(catalog.raw_rows(spark, sf_dir))
    return table.read()


def test_dedup_cuts_groups_before_its_only_shuffle(bronze):
    plan = plan_of(silver_rows(bronze, catalog.SPEC))
    assert plan.count("Exchange") == 1
    assert re.search(r"Final.*Exchange.*WindowGroupLimit[^\n]*Partial", plan, re.S)


def test_gate_reads_rule_columns_only(bronze):
    plan = plan_of(quality.quality_metrics(bronze, PEOPLE))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["age", "id"]
    # One shuffle per distinct key, one for the totals, both behind a partial aggregate.
    assert plan.count("Exchange") == 2


def test_gold_is_partial_then_final(bronze):
    silver = bronze.withColumn("processed_date", F.to_date("ingestion_time"))
    plan = plan_of(marts.gold_by_date(silver, PEOPLE))
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2 and "partial_avg" in plan


def test_pages_are_top_n(bronze):
    for df in (
        marts.latest_rows(bronze, "ingestion_time", ["event_id"]),
        marts.silver_page(bronze.withColumn("processed_date", F.to_date("ingestion_time")), PEOPLE),
    ):
        assert "TakeOrderedAndProject" in plan_of(df)


def test_date_filter_prunes_partitions_of_every_version(spark, sf_dir, tmp_path, capsys):
    table = VersionedTable(spark, str(tmp_path / "silver"), ["processed_date"])
    rows = silver_rows(catalog.raw_rows(spark, sf_dir), catalog.SPEC)
    table.overwrite(rows, rebalance=True)
    table.append(rows)
    table.update("id = 3", {"age": "1"})
    df = table.read().where("processed_date >= date '2024-01-15' and age > 10").select("id")
    df.explain("formatted")
    plan = capsys.readouterr().out
    partition, pushed = (re.search(rf"^{name}: (.*)$", plan, re.M).group(1) for name in ("PartitionFilters", "PushedFilters"))
    assert "processed_date" in partition and "commit_version" in partition
    assert "GreaterThan(age,10)" in pushed
    assert "Exchange" not in plan


def test_no_python_in_any_plan(spark, sf_dir):
    for name in ("silver", "gold", "dq_metrics", "distinct_rows", "file_profile", "generate_people"):
        assert not re.search(r"Python|Pandas|ArrowEval", plan_of(catalog.QUERIES[name](spark, sf_dir))), name
