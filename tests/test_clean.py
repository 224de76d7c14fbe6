from __future__ import annotations

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oreworks.operators import clean

SCHEMA = "id int, name string, age int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, "b", 1), (None, "a", 2), (1, "c", 3)], SCHEMA)
    assert rows(clean.dedup_by_key(df, ["id"])) == rows(
        spark.createDataFrame([(None, "a", 2), (1, "c", 3)], SCHEMA)
    )


def test_order_decides_and_last_column_only_breaks_ties(spark):
    df = spark.createDataFrame([(1, "z", 1), (1, "a", 9), (1, "b", 1)], SCHEMA)
    assert rows(clean.dedup_by_key(df, ["id"], ["age"])) == [(1, "b", 1)]
    assert rows(clean.dedup_by_key(df, ["id"], last=["name"])) == [(1, "b", 1)]


def test_key_only_table(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert clean.dedup_by_key(df, ["id"]).count() == 2


row = st.tuples(
    st.one_of(st.none(), st.integers(0, 5)), st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 3))
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(row, min_size=1, max_size=40))
def test_dedup_against_brute_force(spark, data):
    def nulls_last(r):
        return tuple((v is None, v) if v is not None else (True, 0 if i == 2 else "") for i, v in enumerate(r))

    best = {}
    for r in data:
        if r[0] not in best or nulls_last(r)[1:] < nulls_last(best[r[0]])[1:]:
            best[r[0]] = r
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    once = clean.dedup_by_key(df, ["id"])
    assert rows(once) == sorted(best.values(), key=repr)
    assert rows(clean.dedup_by_key(once, ["id"])) == rows(once)


def test_fill_touches_only_named_nulls(spark):
    df = spark.createDataFrame([(None, None, None), (1, "a", 0)], SCHEMA)
    assert rows(clean.fill_nulls(df, {"age": 45})) == rows(
        spark.createDataFrame([(None, None, 45), (1, "a", 0)], SCHEMA)
    )


def test_distinct_rows_and_date(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "a", 2), (1, "a", 3)], SCHEMA)
    assert clean.distinct_rows(df).count() == 2
    assert clean.distinct_rows(df, ["id", "name"]).count() == 1
    day = spark.createDataFrame([(datetime(2024, 1, 2, 23, 59),)], "t timestamp_ntz")
    assert str(clean.derive_date(day, "t", "d").first()["d"]) == "2024-01-02"
