"""Runs a query's DuckDB SQL over the same Parquet tables and compares the rows."""

import math
from pathlib import Path

import duckdb


def duck(sf):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p if p.is_file() else f'{p}/*.parquet'}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in found)


def compare(df, sql, sf):
    result = duck(sf).sql(sql)
    assert sorted(df.columns) == sorted(result.columns)
    ours, theirs = rows(df.columns, df.collect()), rows(result.columns, result.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs
    return len(ours)
