"""Rows of a query against those of its SQL in DuckDB."""

from __future__ import annotations

import decimal
from pathlib import Path

import duckdb


def plain(x):
    if isinstance(x, float):
        assert x == x, "NaN never equals NaN where results are compared"
        return x + 0.0
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, list | tuple):
        return [plain(y) for y in x]
    return x


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr([plain(r[i]) for i in order]) for r in rows)


def connection(folder: str):
    c = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def agree(spark, folder: str, function, sql: str) -> None:
    df = function(spark, folder)
    c = connection(folder)
    c.execute(sql)
    assert normal(df.columns, df.collect()) == normal([d[0] for d in c.description], c.fetchall())
