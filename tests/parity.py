"""Run registered queries and their SQL counterparts and compare whole results."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(body, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, folder: str, name: str, query, sql: str) -> tuple[bool, str]:
    frame = query(spark, folder)
    have = _table(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    want = _table([d[0] for d in cursor.description], cursor.fetchall())
    if have[0] != want[0]:
        return False, f"{name}: columns {have[0]} != {want[0]}"
    if len(have[1]) != len(want[1]):
        extra = [r for r in have[1] if r not in want[1]][:2] if len(have[1]) < 5000 else []
        lost = [r for r in want[1] if r not in have[1]][:2] if len(have[1]) < 5000 else []
        return False, f"{name}: {len(have[1])} rows != {len(want[1])} {extra} {lost}"
    for a, b in zip(have[1], want[1]):
        if a != b:
            return False, f"{name}: {dict(zip(have[0], a))} != {dict(zip(want[0], b))}"
    return True, f"{name}: {len(have[1])} rows"
