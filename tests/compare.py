"""Compare a Spark result with a DuckDB result, order of rows and columns aside."""

from __future__ import annotations

import math
from collections import Counter
from typing import Any

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value: Any) -> Any:
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_of(columns: list[str], rows: list[tuple[Any, ...]]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def duck_types(con: duckdb.DuckDBPyConnection, sql: str) -> dict[str, str]:
    return {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
