"""Comparison of a Spark result with DuckDB on the same Parquet files."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return value


def sorted_rows(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def differences(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns, types of values and all rows are exactly equal."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    want = sorted_rows(expected.fetchall(), names)
    got = sorted_rows([tuple(r) for r in frame.collect()], frame.columns)
    if not want:
        return "the oracle returns no rows"
    if len(want) != len(got):
        return f"{len(got)} rows, expected {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{mine} != {theirs}"
    return None
