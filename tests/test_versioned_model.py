"""Random sequences of table operations against a plain list of rows."""

from __future__ import annotations

import os
import random

import pytest

from oreworks.sources.versioned import VersionedTable

SCHEMA = "id int, v int, p string"
PARTS = ["a", "b/c", None, "d"]


def rows(data):
    return sorted(data, key=repr)


def matches(op, row):
    """The conditions used below, NULL counting as false."""
    i, v, p = row
    return {
        "v > 5": v is not None and v > 5,
        "id % 3 = 0": i % 3 == 0,
        "p = 'a'": p == "a",
        "p is null and v < 4": p is None and v is not None and v < 4,
        "v is null": v is None,
        "true": True,
    }[op]


CONDITIONS = ["v > 5", "id % 3 = 0", "p = 'a'", "p is null and v < 4", "v is null", "true"]


@pytest.mark.parametrize("seed", range(int(os.environ.get("MODEL_SEQUENCES", "2"))))
def test_random_operations(spark, tmp_path, seed):
    rnd = random.Random(seed)
    table = VersionedTable(spark, str(tmp_path / "t"), ["p"] if seed % 2 == 0 else [])
    model, states = [], []
    for _ in range(8):
        new = [
            (rnd.randint(0, 30), rnd.choice([None, *range(10)]), rnd.choice(PARTS)) for _ in range(rnd.randint(1, 12))
        ]
        df = spark.createDataFrame(new, SCHEMA).coalesce(2)
        ops = ["append", "overwrite", "update", "delete"] + (["replace"] if table.partition_by else [])
        op = rnd.choice(ops) if states else "append"
        cond = rnd.choice(CONDITIONS)
        if op == "append":
            table.append(df)
            model = model + new
        elif op == "overwrite":
            table.overwrite(df, rebalance=rnd.random() < 0.5)
            model = new
        elif op == "replace":
            table.replace_partitions(df)
            gone = {r[2] for r in new}
            model = [r for r in model if r[2] not in gone] + new
        elif op == "update":
            done = table.update(cond, {"v": "id + 1", "id": "coalesce(v, 0)"})
            hits = [r for r in model if matches(cond, r)]
            assert (done.metric("numUpdatedRows") if done else 0) == len(hits)
            model = [(r[1] or 0, r[0] + 1, r[2]) if matches(cond, r) else r for r in model]
        else:
            done = table.delete(cond)
            kept = [r for r in model if not matches(cond, r)]
            assert (done.metric("numDeletedRows") if done else 0) == len(model) - len(kept)
            model = kept
        version = VersionedTable(spark, table.path).commit_at().version
        if version == len(states):
            states.append(rows(model))
        assert rows(tuple(r) for r in table.read().collect()) == rows(model), (op, cond)
    # Later operations left every earlier version as it was.
    for version, state in enumerate(states):
        assert rows(tuple(r) for r in table.read(version=version).collect()) == state
