"""Compare a query with its SQL equivalent, cell by cell."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return repr(float(value))
    return str(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides agree."""
    left_names, left = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    right_names, right = _sorted_rows(names, found.fetchall())
    if left_names != right_names:
        return [f"columns {left_names} and {right_names}"]
    out = [] if len(left) == len(right) else [f"{len(left)} and {len(right)} rows"]
    return out + [f"{a} <> {b}" for a, b in zip(left, right) if a != b][:5]
