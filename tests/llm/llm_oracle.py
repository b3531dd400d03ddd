"""Runs an oracle statement over parquet tables and compares it with a Spark result, row for row."""

import os

import duckdb


def sql_rows(sql, sf, tables=("documents", "pages", "benchmark", "labels", "conversations")):
    con = duckdb.connect()
    for t in (t for t in tables if os.path.exists(f"{sf}/{t}.parquet")):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def same(df, sql, sf):
    names, rows = sql_rows(sql, sf)
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    key = lambda r: tuple(repr(x) for x in r)
    got = sorted((tuple(r[c] for c in order) for r in df.collect()), key=key)
    want = sorted((tuple(r[names.index(c)] for c in order) for r in rows), key=key)
    assert got == want
