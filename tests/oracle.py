"""Compares a Spark result with its SQL counterpart as unordered bags of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(None if r[i] is None else str(r[i]) for i in order) for r in rows)


TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


def compare(df, con, statement: str) -> str | None:
    """None when names, types and rows are equal, else a short description of the difference."""
    kinds = {r[0]: r[1] for r in con.execute("DESCRIBE " + statement).fetchall()}
    if kinds != {c: TYPES[t] for c, t in df.dtypes}:
        return f"types {df.dtypes} against {kinds}"
    cur = con.execute(statement)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    got, want = bag(df.columns, df.collect()), bag(names, cur.fetchall())
    if got == want:
        return None
    return (f"{sum(got.values())} against {sum(want.values())} rows; only Spark "
            f"{list((got - want).items())[:3]}; only SQL {list((want - got).items())[:3]}")
