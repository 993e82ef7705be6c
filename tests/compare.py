"""A query's rows held against its SQL's in DuckDB, over the same parquet files."""

from __future__ import annotations

import math
import os

import duckdb


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows(columns: list[str], found) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=str)


def same(spark, sf_dir: str, query, sql: str) -> None:
    df = query(spark, sf_dir)
    cursor = database(sf_dir).execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cursor.fetchall())
