"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return f"{v:.9f}"
    return v if v is None or isinstance(v, (str, bool)) else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    done = con.execute(sql)
    return _rows([d[0] for d in done.description], done.fetchall())


def duck_types(con, sql):
    return {row[0]: row[1] for row in con.execute(f"describe {sql}").fetchall()}
