"""Runs a query in Spark and its SQL in DuckDB and compares names and rows, order aside."""

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.12g}")
    if isinstance(x, int):
        return x
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(d):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    return c


def differences(df, sql, con):
    """'' if the rows are the same; else what differs."""
    got = con.sql(sql)
    if sorted(df.columns) != sorted(got.columns):
        return f"columns {sorted(df.columns)} and {sorted(got.columns)}"
    a, b = rows_of(df.columns, df.collect()), rows_of(got.columns, got.fetchall())
    if a == b:
        return ""
    sa, sb = set(map(repr, a)), set(map(repr, b))
    return f"{len(a)} and {len(b)} rows; only in Spark: {sorted(sa - sb)[:3]}; only in SQL: {sorted(sb - sa)[:3]}"
