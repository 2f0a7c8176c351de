"""Run a registered query on Spark and its SQL on DuckDB and compare both results."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, int):
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dict):
        return str(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, sql: str, connection) -> tuple[bool, str]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(want) != len(have):
        return False, f"{len(have)} rows, expected {len(want)}: {have[:2]} / {want[:2]}"
    wrong = [(h, w) for h, w in zip(have, want) if h != w]
    if wrong:
        return False, f"{len(wrong)} of {len(want)} rows differ, first (columns {sorted(names)}): {str(wrong[0])[:900]}"
    return True, f"{len(want)} rows"
