"""Comparing Spark results with SQL over the same parquet files, and small frames."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "NULL"
    return f"{value:.6f}" if isinstance(value, float) else str(value)


def bag(columns: list[str], rows) -> list[tuple]:
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(plain(r[i]) for i in at) for r in rows)


def spark_bag(df: DataFrame) -> list[tuple]:
    return bag(df.columns, [tuple(r) for r in df.collect()])


def duck_bag(folder: str, sql: str) -> list[tuple]:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = con.execute(sql)
    return bag([d[0] for d in found.description], found.fetchall())
