"""Compare a registered query with its SQL, both as sorted rows."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    got = rows(df.columns, df.collect())
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    want = rows(names, answer.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    different = [(a, b) for a, b in zip(got, want) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(different)} of {len(got)} rows differ, e.g. {different[:2]}" if different else None
