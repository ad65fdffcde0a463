"""Compare a query's rows with its SQL oracle's, column by column name."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return int(value) if value == int(value) else value
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def in_order(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def from_spark(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    return names, in_order([tuple(plain(v) for v in r) for r in rows])


def from_duckdb(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(plain(r[i]) for i in order) for r in result.fetchall()]
    return [names[i] for i in order], in_order(rows)
