from __future__ import annotations

import shutil
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from oreworks.sources.versioned import VersionedTable

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def people(spark, lo, hi):
    day = F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 3).cast("int"))
    return spark.range(lo, hi).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 90).cast("int")).alias("age"),
        F.when(F.col("id") % 7 != 0, day).alias("day"),
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=[(), ("day",)], ids=["flat", "partitioned"])
def table(spark, tmp_path, request):
    return VersionedTable(spark, str(tmp_path / "t"), request.param)


def test_absent_table(table):
    assert table.read() is None and table.history() is None and not table.exists()
    with pytest.raises(ValueError, match="no table"):
        table.delete("id = 1")


def test_overwrite_append_and_old_versions(spark, table):
    assert table.overwrite(people(spark, 0, 50), timestamp=T0).version == 0
    assert table.append(people(spark, 50, 80), timestamp=T0 + timedelta(hours=1)).version == 1
    assert table.overwrite(people(spark, 5, 9), timestamp=T0 + timedelta(hours=2)).version == 2
    assert rows(table.read()) == rows(people(spark, 5, 9))
    assert rows(table.read(version=1)) == rows(people(spark, 0, 80))
    assert rows(table.read(as_of=T0 + timedelta(minutes=90))) == rows(people(spark, 0, 80))
    assert rows(table.read(as_of=T0)) == rows(people(spark, 0, 50))
    assert table.read(as_of=T0 - timedelta(seconds=1)) is None
    assert table.read(version=9) is None
    assert [r.version for r in table.history().collect()] == [2, 1, 0]


def test_update_and_delete_with_null_conditions(spark, table):
    table.overwrite(people(spark, 0, 100))
    before = people(spark, 0, 100)
    done = table.update("age > 50", {"age": "age + 1", "id": "-id"})
    hit = F.coalesce(F.col("age") > 50, F.lit(False))
    want = before.select(
        F.when(hit, -F.col("id")).otherwise(F.col("id")), F.when(hit, F.col("age") + 1).otherwise(F.col("age")), "day"
    )
    assert rows(table.read()) == rows(want)
    assert done.metric("numUpdatedRows") == before.where(hit).count()
    assert table.read(version=0).count() == 100

    gone = table.delete("age > 60")
    kept = want.toDF("id", "age", "day").where("not coalesce(age > 60, false)")
    assert rows(table.read()) == rows(kept)
    assert gone.metric("numDeletedRows") == 100 - kept.count()
    assert gone.metric("numRemovedFiles") > 0 and gone.metric("numAddedBytes") > 0


def test_delete_of_everything(spark, table):
    table.overwrite(people(spark, 0, 20))
    done = table.delete("true")
    assert (done.metric("numDeletedRows"), done.metric("numCopiedRows")) == (20, 0)
    assert table.read().count() == 0
    assert table.append(people(spark, 0, 3).where("1 = 0")).metric("numOutputRows") == 0
    assert table.update("true", {"age": "1"}) is None


def test_mutation_that_matches_nothing_adds_no_version(spark, table):
    table.overwrite(people(spark, 0, 10))
    assert table.delete("age > 1000") is None
    assert table.update("id = -5", {"age": "1"}) is None
    assert table.commit_at().version == 0


def test_mutation_rewrites_only_touched_partitions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["day"])
    table.overwrite(people(spark, 0, 90))
    done = table.update("id = 1", {"age": "99"})
    touched = people(spark, 0, 90).where("day = date '2024-01-02'").count()
    assert done.metric("numUpdatedRows") == 1
    assert done.metric("numCopiedRows") == touched - 1
    assert table.read(version=1).count() == 90
    # A NULL partition is a partition too.
    table.delete("id = 7")
    assert table.read().where("day is null").count() == people(spark, 0, 90).where("day is null").count() - 1
    assert table.read().count() == 89
    # Live files are those of the untouched partitions and of the rewritten ones.
    live = {(str(r.day), r.commit_version) for r in table.live_files().select("day", "commit_version").collect()}
    assert live == {("2024-01-01", 0), ("2024-01-03", 0), ("2024-01-02", 1), ("None", 2)}
    # Reopened without naming the partitioning, the table still knows it.
    assert VersionedTable(spark, table.path).delete("id = 2").partition_by == ["day"]
    with pytest.raises(ValueError, match="partitioned by"):
        VersionedTable(spark, table.path, ["id"]).append(people(spark, 0, 1))
    with pytest.raises(ValueError, match="partition column"):
        table.update("id = 4", {"day": "null"})


def test_many_partitions_commit_like_few(spark, tmp_path):
    """A mutation or replacement of thousands of partitions keeps the base version and counts as one of ten."""
    kinds = []
    for n in (10, 5000):
        df = spark.range(2 * n).select(F.col("id"), (F.col("id") % n).cast("int").alias("p"), F.lit(0).alias("v"))
        table = VersionedTable(spark, str(tmp_path / f"t{n}"), ["p"])
        table.overwrite(df.repartition(2, "p"))
        done = table.update(f"id < {n}", {"v": "1"})
        kinds.append((done.base_version, done.metric("numUpdatedRows") == n, done.metric("numCopiedRows") == n))
        assert len(done.replaced[1]) == n
        done = table.replace_partitions(df.where("p < 4").withColumn("v", F.lit(2)))
        kinds[-1] += (done.base_version, len(done.replaced[1]) == n - 4, len(done.replaced[2]))
        got = {r.v: r["count"] for r in table.read().groupBy("v").count().collect()}
        assert got == {0: n - 4, 1: n - 4, 2: 8}
    assert kinds[0] == kinds[1] == (0, True, True, 0, True, 4)


def test_partitions_may_differ_in_microseconds(spark, tmp_path):
    df = spark.range(2).select("id", F.timestamp_micros(F.lit(1704067200000000) + F.col("id")).alias("at"))
    table = VersionedTable(spark, str(tmp_path / "t"), ["at"])
    table.overwrite(df)
    table.replace_partitions(df.where("id = 0").withColumn("id", F.lit(7).cast("long")))
    assert sorted(r.id for r in table.read().collect()) == [1, 7]


def test_table_lives_on_when_its_oldest_commits_are_cleaned_away(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for lo in range(3):
        table.overwrite(people(spark, 0, 10 + lo))
    for version in range(2):
        shutil.rmtree(tmp_path / "t" / "commits" / f"commit={version}")
    fresh = VersionedTable(spark, table.path)
    assert fresh.commit_at().version == 2 and fresh.read().count() == 12
    assert fresh.append(people(spark, 0, 1)).version == 3
    assert [r.version for r in fresh.history().collect()] == [3, 2]


def test_compact_keeps_the_rows(spark, table):
    table.append(people(spark, 0, 30))
    table.append(people(spark, 30, 60))
    table.delete("age > 40")
    before = rows(table.read())
    done = table.compact()
    assert rows(table.read()) == before and done.base_version == done.version and not done.replaced


def test_batch_ids_must_name_writer_and_number(spark, table):
    for bad in ("b", "b_", "_1", "a b_1"):
        with pytest.raises(ValueError, match="batch id"):
            table.append(people(spark, 0, 1), batch_id=bad)


def test_replace_partitions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["day"])
    table.overwrite(people(spark, 0, 60))
    new = people(spark, 100, 130).where("day = date '2024-01-02' or day is null")
    for _ in range(2):
        table.replace_partitions(new)
    kept = people(spark, 0, 60).where("day <> date '2024-01-02'")
    assert rows(table.read()) == rows(kept.unionByName(new))
    table.append(new)
    assert table.read().count() == kept.count() + 2 * new.count()
    with pytest.raises(ValueError, match="partitioned table"):
        VersionedTable(spark, str(tmp_path / "flat")).replace_partitions(new)


def test_partition_values_survive_escaping(spark, tmp_path):
    values = ["a/b", "01", "1", "x y+z%", "ü=ü", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, p string")
    table = VersionedTable(spark, str(tmp_path / "t"), ["p"])
    table.overwrite(df)
    for i, v in enumerate(values):
        table.replace_partitions(df.where(F.col("id") == i).withColumn("id", F.col("id") + 100))
        assert table.read().count() == len(values), v
    assert table.read().where("id >= 100").count() == len(values)
    table.update("id = 101", {"id": "1"})
    assert sorted(r.id for r in table.read().collect()) == [1, 100, 102, 103, 104, 105]


def test_schema_evolves_by_adding_columns(spark, table):
    table.append(people(spark, 0, 3))
    table.append(people(spark, 3, 6).withColumn("x", F.lit("new")))
    table.append(people(spark, 6, 9).select("id", "day"))
    assert table.read().columns == ["id", "age", "day", "x"]
    assert table.read().where("x is null").count() == 6
    assert table.read(version=0).columns == ["id", "age", "day"]
    # Also an overwrite keeps the columns it does not bring.
    table.overwrite(people(spark, 0, 2))
    assert table.read().columns == ["id", "age", "day", "x"]
    with pytest.raises(ValueError, match="column age is int"):
        table.append(people(spark, 0, 1).withColumn("age", F.lit("old")))


def test_empty_writes(spark, table):
    table.overwrite(people(spark, 0, 0))
    assert table.read().count() == 0
    assert table.append(people(spark, 0, 4)).metric("numOutputRows") == 4
    assert table.append(people(spark, 0, 0)).metric("numOutputRows") == 0
    assert table.read().count() == 4


def test_batch_is_committed_once(spark, table):
    first = table.append(people(spark, 0, 5), batch_id="q_1")
    again = table.append(people(spark, 0, 5), batch_id="q_1")
    assert again.version == first.version
    assert table.read().count() == 5


def test_batches_of_two_writers(spark, table):
    for batch_id in ("a_1", "b_1", "a_2", "a_2", "b_1", "b_2"):
        table.append(people(spark, 0, 1), batch_id=batch_id)
    assert table.append(people(spark, 0, 1), batch_id="a_2").version == 2
    assert table.commit_at().batches == {"a_2": 2, "b_2": 3}
    table.update("id = 0", {"age": "7"}, batch_id="c_1")
    assert table.update("id = 0", {"age": "8"}, batch_id="c_1").version == 4
    assert {r.age for r in table.read().collect()} == {7}


def test_latest_commit_is_found_without_listing(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for version in range(9):
        table.append(people(spark, version, version + 1))
        fresh = VersionedTable(spark, table.path)
        looks = []
        has_commit = fresh._has_commit
        fresh._has_commit = lambda v: looks.append(v) or has_commit(v)
        assert fresh.commit_at().version == version
        assert len(looks) <= 8
    assert table.read().count() == 9
    # A writer that died while writing its commit row left a folder without rows.
    (tmp_path / "t" / "commits" / "commit=9" / "_temporary").mkdir(parents=True)
    assert VersionedTable(spark, table.path).commit_at().version == 8
    assert table.append(people(spark, 9, 10)).version == 9
    assert VersionedTable(spark, table.path).read().count() == 10


def test_uncommitted_write_is_invisible_and_replaced(spark, table):
    table.append(people(spark, 0, 5))
    people(spark, 0, 1000).write.parquet(f"{table.path}/data/commit_version=1")
    assert table.read().count() == 5
    table.append(people(spark, 5, 9))
    assert table.read().count() == 9


def test_metrics_add_up(spark, table):
    table.append(people(spark, 0, 40))
    table.append(people(spark, 40, 60), rebalance=True)
    done = table.update("id < 30", {"age": "0"})
    written = [int(r.operation_metrics["numOutputRows"]) for r in table.history().where("operation = 'WRITE'").collect()]
    assert sum(written) == 60
    assert done.metric("numUpdatedRows") + done.metric("numCopiedRows") == 60
    sizes = table.live_files().agg(F.sum("length")).first()[0]
    assert sizes > 0
