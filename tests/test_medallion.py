from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from oreworks.operators import datagen
from oreworks.operators.monitor import RUN_SCHEMA, read_incidents
from oreworks.operators.quality import metrics_schema
from oreworks.plans import medallion
from oreworks.plans.medallion import layer_tables, run_medallion
from oreworks.sources.rowlog import read_rows
from oreworks.spec import PEOPLE, Rule, TableSpec

from .conftest import CSV_ROWS, JSON_ROWS

NOON = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)


@pytest.mark.parametrize(
    ("with_csv", "with_json", "want", "silver"),
    [
        (True, False, [9, 1, 2, 1, 3], 6),
        (False, True, [6, 1, 1, 2, 1], 5),
        (True, True, [15, 2, 3, 3, 6], 9),
    ],
)
def test_small_drops(spark, layout, drop, with_csv, with_json, want, silver):
    if with_csv:
        drop("a.csv", CSV_ROWS)
    if with_json:
        drop("b.json", JSON_ROWS)
    result = run_medallion(spark, PEOPLE, layout, at=NOON)
    assert result.status == "succeeded" and result.ok
    assert list(result.metrics.values()) == want
    assert (result.bronze_rows, result.silver_rows, result.gold_rows) == (want[0], silver, 1)

    tables = layer_tables(spark, PEOPLE, layout)
    bronze, out, gold = (tables[n].read() for n in ("bronze", "silver", "gold"))
    assert bronze.columns == ["id", "name", "age", "source_file", "ingestion_time"]
    assert out.where("id is null").count() == 1
    assert out.where("age is null").count() == 0
    assert out.count() + result.metrics["duplicate_ids"] == bronze.count()
    assert gold.agg(F.sum("total_users")).first()[0] == out.count()
    assert read_rows(spark, layout.dq_metrics, metrics_schema(PEOPLE)).count() == 1
    assert read_rows(spark, layout.run_metrics, RUN_SCHEMA).first()["epoch_s"] == NOON.timestamp()


def test_no_input_stops_without_a_trace(spark, layout, drop):
    assert run_medallion(spark, PEOPLE, layout).status == "no_input"
    drop("a.csv", "id,name,age\n")
    assert run_medallion(spark, PEOPLE, layout).status == "no_input"
    assert not layer_tables(spark, PEOPLE, layout)["bronze"].exists()
    assert read_rows(spark, layout.dq_metrics, metrics_schema(PEOPLE)) is None


def test_gate_halts_and_keeps_older_layers(spark, layout, drop):
    drop("a.csv", CSV_ROWS)
    run_medallion(spark, PEOPLE, layout, at=NOON)
    drop("b.json", '{"name": "x"}\n' * 20)
    result = run_medallion(spark, PEOPLE, layout, at=NOON + timedelta(hours=1))
    assert result.status == "halted" and not result.ok
    tables = layer_tables(spark, PEOPLE, layout)
    assert tables["bronze"].read().count() == 29
    assert tables["silver"].read().count() == 6
    incident = read_incidents(spark, layout.trace).first()
    assert (incident.status, incident.task_id) == ("CRITICAL", "validation_step")
    assert incident.run_id == f"run_{int(NOON.timestamp()) + 3600}"
    assert read_rows(spark, layout.run_metrics, RUN_SCHEMA).count() == 1


def test_error_is_logged_and_raised(spark, layout, drop):
    drop("a.csv", "name,id,age\nAnn,1,3\n")
    with pytest.raises(Exception):
        run_medallion(spark, PEOPLE, layout)
    incident = read_incidents(spark, layout.trace).first()
    assert (incident.status, incident.task_id) == ("ERROR", "main_process")
    assert spark.range(1).count() == 1


def test_failed_silver_leaves_the_metrics_row(spark, layout, drop, monkeypatch):
    drop("a.csv", CSV_ROWS)

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(medallion, "silver_rows", broken)
    with pytest.raises(RuntimeError):
        run_medallion(spark, PEOPLE, layout)
    row = read_rows(spark, layout.dq_metrics, metrics_schema(PEOPLE)).first()
    assert (row.total_rows, row.duplicate_ids) == (9, 3)


def test_first_error_is_raised_when_recording_it_fails_too(spark, layout, drop, monkeypatch):
    drop("a.csv", CSV_ROWS)

    def broken(*_, **__):
        raise RuntimeError("first")

    def broken_too(*_, **__):
        raise OSError("second")

    monkeypatch.setattr(medallion, "silver_rows", broken)
    monkeypatch.setattr(medallion, "check_quality", broken_too)
    monkeypatch.setattr(medallion, "log_incident", broken_too)
    with pytest.raises(RuntimeError, match="first"):
        run_medallion(spark, PEOPLE, layout)


def test_shuffle_partitions_follow_the_bronze_bytes(spark, layout, drop, monkeypatch):
    drop("a.csv", CSV_ROWS)
    seen = []
    rows = medallion.silver_rows

    def watched(*args):
        seen.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
        return rows(*args)

    monkeypatch.setattr(medallion, "silver_rows", watched)
    monkeypatch.setattr(medallion, "SHUFFLED_PER_STORED", 10**6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run_medallion(spark, PEOPLE, layout)
    size = layer_tables(spark, PEOPLE, layout)["bronze"].commit_at().metric("numOutputBytes")
    assert seen == [-(-size * 10**6 // (128 << 20))]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_fuller_row_stays(spark, layout, drop):
    drop("a.csv", "id,name,age\n1,Ann,\n1,Ann,30\n2,,7\n2,Bo,7\n")
    run_medallion(spark, PEOPLE, layout)
    silver = layer_tables(spark, PEOPLE, layout)["silver"].read()
    assert sorted(tuple(r) for r in silver.select("id", "name", "age").collect()) == [(1, "Ann", 30), (2, "Bo", 7)]


def test_batch_ids_name_their_writer(spark, layout):
    with pytest.raises(ValueError, match="batch id"):
        run_medallion(spark, PEOPLE, layout, batch_id="b")


def test_silver_modes(spark, layout):
    tables = layer_tables(spark, PEOPLE, layout)

    def raw(lo, hi):
        return spark.range(lo, hi).select(
            F.col("id").cast("int"), F.lit("n").alias("name"), F.lit(20).alias("age"), F.lit("f").alias("source_file")
        )

    def run(lo, hi, at, mode):
        run_medallion(spark, PEOPLE, layout, raw=raw(lo, hi), at=at, silver_mode=mode)
        gold = {str(r.processed_date): r.total_users for r in tables["gold"].read().collect()}
        return tables["silver"].read().count(), gold

    assert run(0, 10, NOON, "append") == (10, {"2024-03-01": 10})
    assert run(5, 20, NOON + timedelta(hours=1), "append") == (25, {"2024-03-01": 25})
    day = timedelta(days=1)
    assert run(0, 3, NOON + day, "append") == (28, {"2024-03-01": 25, "2024-03-02": 3})
    assert run(0, 4, NOON + day, "replace_partitions") == (29, {"2024-03-01": 25, "2024-03-02": 4})
    assert run(0, 2, NOON + 2 * day, "overwrite") == (2, {"2024-03-03": 2})
    with pytest.raises(ValueError, match="mode must be"):
        run(0, 2, NOON, "merge")


def test_retried_batch_commits_each_layer_once(spark, layout, monkeypatch):
    raw = spark.createDataFrame([(1, "a", 2, "f"), (2, "b", None, "f")], "id int, name string, age int, source_file string")

    def broken(*_):
        raise RuntimeError("lost")

    how = {"raw": raw, "silver_mode": "append", "batch_id": "q_0"}
    with monkeypatch.context() as m:
        m.setattr(medallion, "gold_by_date", broken)
        with pytest.raises(RuntimeError):
            run_medallion(spark, PEOPLE, layout, at=NOON, **how)
    # The second try comes on another day; the batch keeps its first one.
    result = run_medallion(spark, PEOPLE, layout, at=NOON + timedelta(days=1), **how)
    tables = layer_tables(spark, PEOPLE, layout)
    assert result.silver_rows == 2
    assert tables["bronze"].commit_at().version == 0
    assert tables["silver"].read().count() == 2
    gold = tables["gold"].read().first()
    assert (str(gold.processed_date), gold.total_users) == ("2024-03-01", 2)
    assert read_rows(spark, layout.dq_metrics, metrics_schema(PEOPLE)).count() == 1


def test_conflicting_duplicates_give_the_same_silver_every_time(spark, layout):
    rows = datagen.people_with_reused_ids(spark.range(1, 3001), 0.05, 300).withColumn("source_file", F.lit("f"))
    seen = []
    for parts in (1, 7):
        run_medallion(spark, PEOPLE, layout, raw=rows.repartition(parts), at=NOON)
        silver = layer_tables(spark, PEOPLE, layout)["silver"].read()
        seen.append(sorted(tuple(r) for r in silver.select("id", "name", "age").collect()))
    assert seen[0] == seen[1]
    assert len(seen[0]) == 3000


def test_another_table(spark, layout, drop):
    """Two-column key, two blocking rules, other names and measures."""
    spec = TableSpec(
        schema=StructType([StructField("shop", StringType()), StructField("day", IntegerType()), StructField("sold", DoubleType())]),
        key=("shop", "day"),
        rules=(
            Rule("no_shop", "shop IS NULL", "No shop", max_ratio=0.5),
            Rule("negative", "sold < 0", "Negative", max_ratio=0.25),
        ),
        fill={"sold": 0.0, "shop": "?"},
        order_by=("sold",),
        measures={"best": "max(sold)", "shops": "count(distinct shop)"},
        duplicate_metric="repeats",
        time_column="loaded_at",
        file_column="origin",
        date_column="loaded_on",
    )
    drop("a.csv", "shop,day,sold\na,1,5\na,1,4\na,2,\n,1,7\n,1,7\nb,1,-1\n")
    result = run_medallion(spark, spec, layout, at=NOON)
    assert dict(result.metrics) == {"total_rows": 6, "no_shop": 2, "negative": 1, "repeats": 2}
    tables = layer_tables(spark, spec, layout)
    silver = tables["silver"].read()
    assert silver.columns == ["shop", "day", "sold", "origin", "loaded_at", "loaded_on"]
    got = sorted(tuple(r) for r in silver.select("shop", "day", "sold").collect())
    assert got == [("?", 1, 7.0), ("a", 1, 4.0), ("a", 2, 0.0), ("b", 1, -1.0)]
    gold = tables["gold"].read().first()
    assert (str(gold.loaded_on), gold.best, gold.shops) == ("2024-03-01", 7.0, 3)

    drop("b.csv", "shop,day,sold\nc,1,-5\nc,2,-5\n")
    assert run_medallion(spark, spec, layout, at=NOON).status == "halted"
