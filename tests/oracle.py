"""Holds a query's rows against SQL: sorted columns, sorted rows, doubles to nine digits."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def _plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x + 0.0:.9g}"
    if hasattr(x, "as_tuple"):
        return f"{float(x):.9g}"
    if isinstance(x, bool) or x is None:
        return str(x)
    return f"{float(x):.9g}" if isinstance(x, int) else str(x)


def canonical(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str:
    """'' if both give the same rows, else what differs first."""
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = canonical([x[0] for x in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns: only here {sorted(set(got[0]) - set(want[0]))}, only in SQL {sorted(set(want[0]) - set(got[0]))}"
    if len(got[1]) != len(want[1]):
        return f"rows: {len(got[1])} and {len(want[1])}"
    for a, b in zip(got[1], want[1], strict=True):
        if a != b:
            return f"{[(n, x, y) for n, x, y in zip(got[0], a, b, strict=True) if x != y][:4]}"
    return ""
