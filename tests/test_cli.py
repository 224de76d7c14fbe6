from __future__ import annotations

import os

from oreworks.__main__ import main
from oreworks.session import sized_shuffles, wanted_partitions

from .conftest import CSV_ROWS, JSON_ROWS


def test_commands(spark, layout, drop, capsys):
    def run(*args):
        code = main([args[0], "--base", layout.base, *args[1:]])
        return code, capsys.readouterr().out

    assert "silver|        0" in run("counts")[1] and "0.00" in run("status")[1]
    drop("a.csv", CSV_ROWS)
    code, out = run("run")
    assert code == 0 and "succeeded" in out
    assert "silver|        6" in run("counts")[1]
    assert "duplicate_ids" in run("status")[1]
    for i in range(25):
        drop(f"p{i:02}.txt.csv", "id,name,age\n")
    drop("p.csv", "a,b\n1,2\n1,2\n")
    shown = run("profile")[1]
    assert "a.csv" in shown and '"duplicate_rows":1' in shown
    run("update", "--where", "id = 305", "--set", "age=age + 1", "name=upper(name)")
    assert "UPDATE" in run("history")[1]
    run("delete", "--where", "age < 0")
    assert "silver|        4" in run("counts")[1]
    assert run("incident", "d", "r", "t", "it's down")[0] == 0
    assert run("export", "--to", f"{layout.base}/out")[0] == 0
    assert spark.read.option("header", True).csv(f"{layout.base}/out").count() == 4
    assert run("merge-logs")[0] == 0
    os.remove(f"{layout.input}/p.csv")
    drop("b.json", JSON_ROWS)
    assert run("watch", "--once", "--silver-mode", "overwrite", "--max-files", "100")[0] == 0
    assert "silver|        9" in run("counts")[1]
    drop("c.json", '{"name": "x"}\n' * 30)
    assert run("run")[0] == 2


def test_shuffle_sizing(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffles(spark, 10**12, target_bytes=10**9) as n:
        assert n == 1000 and spark.conf.get("spark.sql.shuffle.partitions") == "1000"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with sized_shuffles(spark, 1) as n:
        assert n == int(before)
    assert wanted_partitions(10**14) == 745_059
    assert wanted_partitions(10**14, at_most=50_000) == 50_000
