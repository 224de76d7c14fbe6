from __future__ import annotations

import os

import pytest

from oreworks.session import build_session
from oreworks.spec import Layout

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "oreworks-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layout(tmp_path):
    (tmp_path / "input").mkdir()
    return Layout(str(tmp_path))


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


# Two drops of cities. CSV: 9 rows, 6 keys, 1 NULL id, 2 negative ages, 1 above 120.
# JSON: 6 rows, 5 keys (one of them in the CSV too), 1 NULL id, 1 negative age, 2 above 120.
CSV_ROWS = """id,name,age
301,Oslo,52
,Quito,-1
302,Lima,
303,Cairo,121
301,Oslo,52
304,Perth,-30
303,Cairo,9
305,,64
302,Lima,17
"""
JSON_ROWS = """{"id": 401, "name": "Turin"}
{"age": 200, "id": 402, "name": "Basel"}
{"id": 402, "name": "Basel", "age": 200}
{"id": 301, "name": "Osaka", "age": 40}
{"id": 403, "name": null, "age": -2}
{"name": "Delft", "age": 18}
"""


@pytest.fixture
def drop(layout):
    """Write a file into the input folder."""

    def write(name: str, text: str, modified: float | None = None) -> None:
        path = f"{layout.input}/{name}"
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
        if modified is not None:
            os.utime(path, (modified, modified))

    return write


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
