"""Compare a registered query with its reference SQL, value by value."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    # -0.0 and 0.0 are the same number; everything else must match in type too.
    return 0.0 if isinstance(value, float) and value == 0 else value


def _bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty if both give the same columns and the same rows, in any order."""
    want = con.execute(sql)
    want_columns = [d[0] for d in want.description]
    want_rows = want.fetchall()
    if sorted(df.columns) != sorted(want_columns):
        return [f"columns {sorted(set(df.columns) ^ set(want_columns))}"]
    ours = _bag([tuple(r) for r in df.collect()], df.columns)
    theirs = _bag(want_rows, want_columns)
    out = []
    if ours.total() != theirs.total():
        out.append(f"rows {ours.total()} and {theirs.total()}")
    only_ours, only_theirs = ours - theirs, theirs - ours
    if only_ours or only_theirs:
        names = sorted(df.columns)
        out.append(f"{only_ours.total()} and {only_theirs.total()} rows differ")
        pairs = zip(
            sorted(only_ours, key=repr)[:3], sorted(only_theirs, key=repr)[:3], strict=False
        )
        for a, b in pairs:
            cells = [
                f"{n}: {x!r} / {y!r}"
                for n, x, y in zip(names, a, b, strict=True)
                if x != y or type(x) is not type(y)
            ]
            out.append("; ".join(cells))
    elif any(
        type(x) is not type(y)
        for a, b in zip(sorted(ours, key=repr), sorted(theirs, key=repr), strict=True)
        for x, y in zip(a, b, strict=True)
    ):
        out.append("value types differ")
    return out
