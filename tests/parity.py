"""Holds a query's rows against its SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}/*.parquet')" if p.is_dir() else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return list(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows(columns: list[str], data) -> list[str]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


def difference(df, con, sql: str) -> str | None:
    """None if the rows are the same; else what differs."""
    rel = con.sql(sql)
    names, theirs = list(rel.columns), rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    ours = [tuple(r) for r in df.collect()]
    a, b = rows(df.columns, ours), rows(names, theirs)
    if a != b:
        x, y = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return f"{len(a)} and {len(b)} rows; only ours {x}; only theirs {y}"
    return None
