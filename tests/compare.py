"""Compare a Spark result with the SQL twin's result, order-insensitively."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _normal(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_normal(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def differences(df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    found = []
    left_types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    right_types = dict(zip(rel.columns, map(str, rel.types)))
    if left_types != right_types:
        found.append(f"types: {set(left_types.items()) ^ set(right_types.items())}")
    if sorted(left_types) != sorted(right_types):
        return found
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])[1]
    right = rows_of(rel.columns, rel.fetchall())[1]
    if len(left) != len(right):
        found.append(f"row counts: {len(left)} and {len(right)}")
    if left != right:
        a, b = set(left), set(right)
        found.append(f"only in Spark: {sorted(a - b, key=repr)[:3]}; only in SQL: {sorted(b - a, key=repr)[:3]}")
    return found
