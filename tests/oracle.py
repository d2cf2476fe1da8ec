"""Compare a Spark result with DuckDB's: column names, row count and values in any order."""

import math
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def _plain(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return str(v)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def duck_table(c, sql):
    r = c.sql(sql)
    return table(r.columns, r.fetchall())
