"""Runs a registered query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in data)


def compare(df, con, sql: str) -> None:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows(names, result.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(df.columns) == sorted(names)
    assert sum(got.values()) == sum(expected.values())
    assert got == expected, (list((got - expected))[:3], list((expected - got))[:3])
