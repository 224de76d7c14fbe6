from __future__ import annotations

import csv
import glob
from datetime import date, datetime

from pyspark.sql import functions as F

from oreworks.operators import export, marts
from oreworks.spec import PEOPLE

SCHEMA = "id int, name string, age int, processed_date date"
D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def test_gold_and_trend(spark):
    silver = spark.createDataFrame([(1, "a", 10, D2), (2, "b", 15, D2), (3, "c", 7, D1)], SCHEMA)
    gold = marts.gold_by_date(silver, PEOPLE)
    assert dict(gold.dtypes) == {"processed_date": "date", "average_age": "double", "total_users": "bigint"}
    assert [tuple(r) for r in marts.gold_trend(gold, PEOPLE).collect()] == [(D1, 7.0), (D2, 12.5)]
    assert gold.agg(F.sum("total_users")).first()[0] == silver.count()


def test_absent_layers_count_zero(spark):
    funnel = marts.layer_funnel(spark, spark.range(5), spark.range(3), None)
    assert {r.stage: r.row_count for r in funnel.collect()} == {
        "Bronze (Raw)": 5,
        "Silver (Cleaned)": 3,
        "Gold (Aggregated)": 0,
    }


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 19, 20, None]], "age int")
    bins = {r.bin: r.n for r in marts.histogram(df, "age", 20).collect()}
    assert bins == {0: 1, 1: 1, 19: 2}
    odd = spark.createDataFrame([(v,) for v in [1.0, 50.0, 101.0, float("nan"), None]], "v double")
    assert [(r.bin, r.n) for r in marts.histogram(odd, "v", 2).collect()] == [(0, 2), (1, 1)]
    same = spark.createDataFrame([(7,), (7,)], "age int")
    assert [(r.bin, r.n) for r in marts.histogram(same, "age").collect()] == [(0, 2)]
    assert marts.histogram(spark.createDataFrame([(None,)], "age int"), "age").collect() == []


def test_page_order_puts_null_key_first(spark):
    silver = spark.createDataFrame([(2, "a", 1, D2), (None, "b", 1, D2), (1, "c", 1, D1)], SCHEMA)
    assert [r.name for r in marts.silver_page(silver, PEOPLE, 2).collect()] == ["b", "a"]


def test_export_is_ordered_across_parts_even_with_equal_keys(spark, tmp_path):
    silver = spark.range(2000).select(
        F.lit(None).cast("int").alias("id"),
        F.format_string("n%04d", "id").alias("name"),
        F.lit(1).alias("age"),
        F.lit(D1).alias("processed_date"),
    )
    tail = spark.createDataFrame([(i, "x", 2, D1) for i in range(50)], SCHEMA)
    out = str(tmp_path / "out")
    export.export_csv(silver.unionByName(tail), out, marts.silver_order(PEOPLE))
    lines = []
    for part in sorted(glob.glob(f"{out}/part-*")):
        with open(part, encoding="utf-8") as f:
            header, *body = f.read().splitlines()
        assert header == "id,name,age,processed_date"
        lines += body
    assert len(lines) == 2050
    assert all(line.startswith(",n") for line in lines[:2000])
    assert [int(line.split(",")[0]) for line in lines[2000:]] == list(range(50))


def test_export_keeps_text_and_times_exactly(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'say "a, b"', datetime(2024, 1, 2, 3, 4, 5, 678901)), (2, "", None), (3, "plain", None)],
        "id int, name string, at timestamp_ntz",
    )
    export.export_csv(df.coalesce(1), str(tmp_path / "out"), [F.col("id")])
    (part,) = glob.glob(f"{tmp_path}/out/part-*")
    with open(part, newline="", encoding="utf-8") as f:
        assert list(csv.reader(f)) == [
            ["id", "name", "at"],
            ["1", 'say "a, b"', "2024-01-02 03:04:05.678901"],
            ["2", "", ""],
            ["3", "plain", ""],
        ]
