"""Run a registered query and its SQL side by side and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(folder, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, (int,)):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        v = float(v)
        if math.isnan(v):
            return "nan"
        return str(int(v)) if v == int(v) and abs(v) < 1e15 else repr(v + 0.0)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_norm, v)) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in v.items()) + "}"
    return str(v)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(_norm(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    names = sorted(cols)
    at = [cols.index(n) for n in names]
    return names, sorted(tuple(_norm(r[i]) for i in at) for r in cur.fetchall())


def difference(left, right) -> str | None:
    """None when equal, else what differs."""
    (ln, lr), (rn, rr) = left, right
    if ln != rn:
        return f"columns {ln} against {rn}"
    if len(lr) != len(rr):
        return f"{len(lr)} rows against {len(rr)}: {lr[:3]} / {rr[:3]}"
    bad = [(a, b) for a, b in zip(lr, rr) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
