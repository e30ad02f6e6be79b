"""Compare a query with its SQL: same columns, same rows, any order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda v: float(f"{v:.12g}") if isinstance(v, float) and math.isfinite(v) else v
    return [columns[i] for i in order], sorted((tuple(clean(r[i]) for i in order) for r in rows), key=repr)


def check(df, con, sql: str) -> int:
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0], (got[0], want[0])
    assert len(got[1]) == len(want[1]), (len(got[1]), len(want[1]))
    different = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    assert not different, different[:2]
    return len(got[1])
