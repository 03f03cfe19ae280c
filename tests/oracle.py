"""Side-by-side comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import contextlib
import datetime
import decimal
import io
import math
from collections import Counter

import duckdb

TABLES = """
    region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations
""".split()


def connect(sf: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, db, sql: str) -> list[str]:
    """What differs; an empty list means equal."""
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    wanted = _rows(names, result.fetchall())
    got = _rows(df.columns, df.collect())
    found = []
    if sorted(names) != sorted(df.columns):
        found.append(f"columns: {sorted(df.columns)} vs {sorted(names)}")
    if got.total() != wanted.total():
        found.append(f"rows: {got.total()} vs {wanted.total()}")
    for row in list((got - wanted).items())[:3]:
        found.append(f"only in Spark: {row}")
    for row in list((wanted - got).items())[:3]:
        found.append(f"only in DuckDB: {row}")
    return found


def plan_text(df) -> str:
    """The formatted physical plan."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
