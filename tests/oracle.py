"""Compares a Spark result with what DuckDB makes of an SQL statement over the same parquet tables."""

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def sql_rows(sql, sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def plain(x):
    if isinstance(x, float | decimal.Decimal):
        return "nan" if math.isnan(x) else f"{float(x):.9g}"
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return repr(x)


def differences(df, sql, sf):
    """Rows of either side that the other lacks, by column name."""
    names, rows = sql_rows(sql, sf)
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    order = sorted(names)
    got = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    want = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in rows)
    if got == want:
        return []
    extra, lacking = set(got) - set(want), set(want) - set(got)
    return [f"{len(got)} and {len(want)} rows", *map(str, sorted(extra)[:3]), "lacks", *map(str, sorted(lacking)[:3])]
