"""Comparison of a query's rows with those of its oracle SQL, whatever the order."""

import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def value(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{round(float(v), 5) + 0.0:.5f}"
    return str(list(v)) if isinstance(v, (list, tuple)) else str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(value(r[i]) for i in order) for r in data)


def of_spark(df):
    return sorted(df.columns), rows(df.columns, [tuple(r) for r in df.collect()])


def of_sql(con, sql):
    got = con.execute(sql)
    columns = [d[0] for d in got.description]
    return sorted(columns), rows(columns, got.fetchall())
