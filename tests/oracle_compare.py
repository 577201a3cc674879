"""Run registered queries in Spark and their SQL in DuckDB and compare the rows exactly."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

from cloakframe.sources.tables import TABLES


def duckdb_views(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(directory, t)}.parquet'")
    return con


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns and rows agree, else what differs."""
    columns = df.columns
    got = bag(columns, df.collect())
    cursor = con.execute(sql)
    wanted_columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(wanted_columns):
        return f"columns {sorted(columns)} != {sorted(wanted_columns)}"
    wanted = bag(wanted_columns, cursor.fetchall())
    if got == wanted:
        return None
    only_spark, only_sql = got - wanted, wanted - got
    return (
        f"{sum(got.values())} vs {sum(wanted.values())} rows; columns {sorted(columns)}\n"
        f"  only spark: {list(only_spark)[:3]}\n  only sql:   {list(only_sql)[:3]}"
    )
