"""Holds a query against its SQL in DuckDB over the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb

DATA = Path("/root/testdata/sf0.001")


def _plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    return str([_plain(x) for x in value]) if isinstance(value, (list, tuple)) else str(value)


def assert_equal(spark, query, sql: str) -> None:
    con = duckdb.connect()
    for path in DATA.iterdir():
        con.sql(f"CREATE VIEW {path.name.split('.')[0]} AS SELECT * FROM '{path / '*.parquet' if path.is_dir() else path}'")
    df, want = query(spark, str(DATA)), con.sql(sql)
    names = sorted(want.columns)
    assert sorted(df.columns) == names
    at = [want.columns.index(n) for n in names]
    assert sorted([_plain(r[n]) for n in names] for r in df.collect()) == sorted([_plain(r[i]) for i in at] for r in want.fetchall())
