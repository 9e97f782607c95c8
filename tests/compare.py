"""Run a query and its checking SQL on the same tables and compare the rows as multisets."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(df, con, sql: str) -> list[str]:
    """What differs, empty if nothing; columns are matched by name, values exactly."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    expected = relation.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    found = [tuple(r) for r in df.select(*names).collect()]
    left, right = Counter(found), Counter(expected)
    if left == right:
        return []
    ours, theirs = left - right, right - left
    lines = [f"rows {len(found)} != {len(expected)}, {sum(ours.values())} only ours"]
    order = lambda row: tuple(str(v) for v in row)
    lines += [f"ours   {dict(zip(names, r))}" for r in sorted(ours, key=order)[:3]]
    lines += [f"theirs {dict(zip(names, r))}" for r in sorted(theirs, key=order)[:3]]
    return lines
