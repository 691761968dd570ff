"""Runs a bound query and its SQL twin side by side and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def rows(names, tuples) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(t[i]) for i in order) for t in tuples)


def compare(spark, con, sf_dir: str, function, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = function(spark, sf_dir)
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if not theirs:
        return "the SQL gives no rows"
    if ours != theirs:
        extra, lost = ours - theirs, theirs - ours
        return (
            f"{sum(ours.values())} vs {sum(theirs.values())} rows; columns {sorted(names)}\n"
            f"only Spark: {list(extra)[:3]}\nonly SQL: {list(lost)[:3]}"
        )
    return None
