"""Runs a registered query in Spark and its check SQL in DuckDB and compares the answers."""

from __future__ import annotations

import glob
import math
import os

import duckdb

_KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
}


def duck(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    names = sorted(df.columns)
    kinds = {n: _KINDS.get(t, t) for n, t in df.dtypes}
    got = sorted(tuple(_plain(r[n]) for n in names) for r in df.collect())
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    rows = cur.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(cols) != names:
        return f"columns {names} != {sorted(cols)}"
    want = sorted(tuple(_plain(r[cols.index(n)]) for n in names) for r in rows)
    if kinds != types:
        return f"types {[(n, kinds[n], types[n]) for n in names if kinds[n] != types[n]]}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}"
    if not got:
        return "both empty"
    return None
