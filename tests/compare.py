"""Order-free, exact comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads=4")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value.isoformat() if hasattr(value, "isoformat") else repr(value)


def canonical(names, rows) -> tuple[list, list]:
    """Columns sorted by name, rows sorted by their text."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def spark_result(df) -> tuple[list, list]:
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql: str) -> tuple[list, list]:
    res = con.execute(sql)
    return canonical([d[0] for d in res.description], res.fetchall())
