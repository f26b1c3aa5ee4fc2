"""Runs a query's SQL in DuckDB over the same Parquet tables and compares rows."""

import os

import duckdb


def rows_of(sql, folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        path = f"{folder}/{f}"
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    found = con.execute(sql)
    names = [x[0] for x in found.description]
    return [dict(zip(names, r)) for r in found.fetchall()]


def same(df, sql, folder):
    want = rows_of(sql, folder)
    got = [r.asDict() for r in df.collect()]
    assert not want or sorted(want[0]) == sorted(df.columns)
    key = lambda r: tuple((v is not None, str(v)) for _, v in sorted(r.items()))
    got, want = sorted(map(key, got)), sorted(map(key, want))
    assert got == want, next((x for x in zip(got, want) if x[0] != x[1]), (len(got), len(want)))
    return got
