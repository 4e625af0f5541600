"""Run registered queries and their SQL side by side and compare whole results."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def compare(spark_df, con, sql: str) -> str | None:
    """None when both hold the same rows, else what differs."""
    theirs = con.sql(sql)
    names = sorted(theirs.columns)
    if names != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {names}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    want = dict(zip(theirs.columns, map(str, theirs.types)))
    for name, kind in spark_df.dtypes:
        if kinds.get(kind, kind) != want[name]:
            return f"type of {name}: {kind} vs {want[name]}"
    a = sorted((tuple(map(_cell, r)) for r in spark_df.select(*names).collect()), key=repr)
    b = sorted((tuple(map(_cell, r)) for r in theirs.select(*[f'"{n}"' for n in names]).fetchall()), key=repr)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}; first {a[:1]} vs {b[:1]}"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference {x} vs {y}"
    return None
