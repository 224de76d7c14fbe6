"""Every registered query against the same query in DuckDB."""

from __future__ import annotations

import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oreworks.plans.catalog import QUERIES

from .oracle_compare import connect, duck_rows, duck_types, spark_rows


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


TYPES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df, sql = queries()[name](spark, sf_dir), oracle_sql()[name]
    assert dict(df.dtypes) == {column: TYPES[kind] for column, kind in duck_types(duck, sql).items()}
    assert spark_rows(df) == duck_rows(duck, sql)


def test_entry(spark):
    row = entry(spark).first()
    assert (row.status, row.silver_rows) == ("succeeded", 887)


def test_entry_without_what_the_text_operators_need():
    """The table queries load where the tokenizers, or the text operators, are not there."""
    code = "import sys\nsys.modules[{!r}] = None\nimport __spark_entry__ as e\nprint(len(e.queries()), sorted(e.queries()) == sorted(e.QUERIES))"
    for absent in ("tokenizers", "oreworks.llm", "corpus_pipeline"):
        done = subprocess.run([sys.executable, "-c", code.format(absent)], capture_output=True, text=True, check=True)
        assert done.stdout.split() == [str(len(QUERIES)), "True"]
