"""Runs a registered query and its SQL on one folder and compares them."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def differences(spark, con, query, sql: str, sf_dir: str) -> tuple[int, list, list]:
    """Row count and the first rows only one side has."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*names).collect())
    rel = con.sql(sql)
    assert sorted(rel.columns) == names, (sorted(rel.columns), names)
    quoted = ", ".join(f'"{n}"' for n in names)
    want = Counter(rel.project(quoted).fetchall())
    return sum(got.values()), list((got - want).items())[:3], list((want - got).items())[:3]
