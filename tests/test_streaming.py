from __future__ import annotations

import os

import pytest

from oreworks.operators.monitor import read_incidents
from oreworks.plans import catalog
from oreworks.plans.medallion import layer_tables
from oreworks.sources import versioned
from oreworks.spec import PEOPLE, Layout
from oreworks.streaming.files import ingest_arrivals, land_arrivals, medallion_arrivals

from .conftest import CSV_ROWS, JSON_ROWS


def people(df):
    return sorted((tuple(r) for r in df.select("id", "name", "age").collect()), key=repr)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_files_are_taken_once_over_restarts(spark, layout, drop):
    bronze = layer_tables(spark, PEOPLE, layout)["bronze"]
    drop("a.csv", CSV_ROWS)
    drop("a.json", JSON_ROWS)
    assert ingest_arrivals(spark, PEOPLE, layout) == 1
    assert bronze.read().count() == 15
    assert ingest_arrivals(spark, PEOPLE, layout) == 0
    assert bronze.commit_at().version == 0
    drop("b.csv", CSV_ROWS)
    assert ingest_arrivals(spark, PEOPLE, layout, archive=True) == 1
    drop("c.json", JSON_ROWS)
    assert ingest_arrivals(spark, PEOPLE, layout, archive=True) == 1
    assert bronze.read().count() == 30
    drop("d.json", JSON_ROWS)
    assert ingest_arrivals(spark, PEOPLE, layout, archive=True) == 1
    # Spark moves a batch's files when a later batch is planned, also those of the last batch before archiving was asked for.
    moved = {name.split("_", 3)[3] for _, _, names in os.walk(layout.archive) for name in names if not name.endswith(".crc")}
    assert {"b.csv"} <= moved <= {"a.csv", "a.json", "b.csv", "c.json", "d.json"}
    files = {r.source_file.removeprefix("file:") for r in bronze.read().select("source_file").distinct().collect()}
    assert files == {f"{layout.input}/{n}" for n in ("a.csv", "a.json", "b.csv", "c.json", "d.json")}
    assert os.listdir(layout.input) == []


def test_one_batch_holds_both_kinds(spark, layout, drop):
    drop("a.csv", CSV_ROWS)
    drop("b.json", JSON_ROWS)
    results = []
    assert medallion_arrivals(spark, PEOPLE, layout, on_result=results.append) == 1
    assert results[0].bronze_rows == 15


def test_landing_gives_each_arrival_a_path_of_its_own(spark, layout, drop):
    for n in range(3):
        drop("x y.csv", f"id,name,age\n{n},n,1\n", 1_000_000)
        drop("empty.csv", "")
        drop("other.txt", "x")
        assert land_arrivals(spark, layout) == 1
    landed = sorted(n for n in os.listdir(layout.landing) if n.endswith(".csv") and not n.startswith("."))
    assert len(landed) == 3 and all(n.endswith("_1000000000_18_x y.csv") for n in landed)
    assert sorted(n for n in os.listdir(layout.input) if not n.startswith(".")) == ["empty.csv", "other.txt"]
    assert ingest_arrivals(spark, PEOPLE, layout) == 1
    assert ids(layer_tables(spark, PEOPLE, layout)["bronze"].read()) == [0, 1, 2]


def test_a_running_query_takes_what_arrives_later(spark, layout, drop):
    class Enough(Exception):
        pass

    def each(result):
        results.append(result.bronze_rows)
        drop("b.json", JSON_ROWS)
        if len(results) == 2:
            raise Enough

    results = []
    drop("a.csv", CSV_ROWS)
    with pytest.raises(Enough):
        medallion_arrivals(spark, PEOPLE, layout, every=0.5, on_result=each)
    assert results == [9, 6]


@pytest.mark.parametrize("archive", [False, True])
def test_a_used_name_is_a_new_arrival(spark, layout, drop, archive):
    bronze = layer_tables(spark, PEOPLE, layout)["bronze"]
    for n, at in ((1, None), (2, 1_000_000_000), (3, None)):
        drop("raw_data.csv", f"id,name,age\n{n},n,{n}\n", at)
        assert ingest_arrivals(spark, PEOPLE, layout, archive=archive) == 1
        assert ingest_arrivals(spark, PEOPLE, layout, archive=archive) == 0
    assert ids(bronze.read()) == [1, 2, 3]


def test_old_files_are_taken(spark, layout, drop):
    drop("a.csv", "id,name,age\n1,a,1\n")
    drop("b.csv", "id,name,age\n2,b,2\n", 1_000_000)
    ingest_arrivals(spark, PEOPLE, layout)
    assert ids(layer_tables(spark, PEOPLE, layout)["bronze"].read()) == [1, 2]


def test_bounded_batches_equal_one_batch(spark, layout, drop):
    for i in range(3):
        drop(f"{i}.csv", f"id,name,age\n{i},n{i},{20 + i}\n{i},n{i},{20 + i}\n")
    results = []
    assert medallion_arrivals(spark, PEOPLE, layout, silver_mode="append", max_files=1, on_result=results.append) == 3
    tables = layer_tables(spark, PEOPLE, layout)
    assert [r.silver_rows for r in results] == [1, 1, 1]
    assert people(tables["silver"].read()) == [(0, "n0", 20), (1, "n1", 21), (2, "n2", 22)]
    assert tables["gold"].read().first()["total_users"] == 3


def test_halted_batch_is_taken_and_logged(spark, layout, drop):
    drop("a.json", '{"name": "x"}\n')
    results = []
    medallion_arrivals(spark, PEOPLE, layout, on_result=results.append)
    assert [r.status for r in results] == ["halted"]
    medallion_arrivals(spark, PEOPLE, layout, on_result=results.append)
    assert len(results) == 1
    assert read_incidents(spark, layout.trace).first()["status"] == "CRITICAL"


def test_failed_batch_is_tried_again_over_the_same_files(spark, layout, drop):
    drop("a.csv", CSV_ROWS)

    def fail(_):
        raise RuntimeError("after the layers")

    with pytest.raises(RuntimeError):
        medallion_arrivals(spark, PEOPLE, layout, on_result=fail)
    drop("b.csv", "id,name,age\n1,a,1\n")
    results = []
    assert medallion_arrivals(spark, PEOPLE, layout, on_result=results.append) == 2
    assert [r.silver_rows for r in results] == [6, 1]
    assert layer_tables(spark, PEOPLE, layout)["bronze"].commit_at().version == 1


def test_append_that_died_before_its_mark_is_not_doubled(spark, layout, drop, monkeypatch):
    drop("a.csv", CSV_ROWS)
    with monkeypatch.context() as m:
        commit = versioned.VersionedTable.append

        def dies(self, *args, **how):
            commit(self, *args, **how)
            raise RuntimeError("lost")

        m.setattr(versioned.VersionedTable, "append", dies)
        with pytest.raises(RuntimeError):
            ingest_arrivals(spark, PEOPLE, layout)
    assert ingest_arrivals(spark, PEOPLE, layout) == 1
    assert layer_tables(spark, PEOPLE, layout)["bronze"].read().count() == 9


def test_new_checkpoint_is_a_new_query(spark, layout, drop):
    """Batch numbers start again; the batches are not taken for those already committed."""
    drop("a.csv", CSV_ROWS)
    ingest_arrivals(spark, PEOPLE, layout)

    class Other(Layout):
        def checkpoint(self, query):
            return f"{self.base}/second/{query}"

    ingest_arrivals(spark, PEOPLE, Other(layout.base))
    batches = layer_tables(spark, PEOPLE, layout)["bronze"].commit_at().batches
    assert sorted(batches.values()) == [0, 1]
    assert all(b.endswith("_0") and "None" not in b for b in batches)


@pytest.mark.parametrize("query", [catalog.stream_ingest, catalog.stream_medallion], ids=lambda q: q.__name__)
def test_tasks_without_rows_leave_no_arrivals(spark, tmp_path, query):
    """The first task of either half finds no row for JSON and writes an empty file; the other tasks' files arrive under used names."""
    even, odd = list(range(2, 22, 2)), [1, 3, 5, 7, 9]
    for part in (even, odd):
        rows = spark.createDataFrame([(i, "signup", 30.0) for i in part], "event_id long, event_type string, value double")
        rows = rows.selectExpr("*", "timestamp'2024-01-01 00:00:00' as ts").coalesce(1)
        rows.write.mode("append").parquet(str(tmp_path / "events.parquet"))
    assert catalog.raw_rows(spark, str(tmp_path)).rdd.getNumPartitions() == 2
    assert ids(query(spark, str(tmp_path))) == sorted(even + odd)
