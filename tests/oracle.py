"""Holds a Spark result against DuckDB on the same tables."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.9g}"
    return str(x)


def rows(df):
    names = sorted(df.columns)
    table = df.select(*names).toArrow()
    return names, sorted(tuple(map(cell, r)) for r in zip(*(c.to_pylist() for c in table.columns)))


def twin(con, sql):
    found = con.sql(sql)
    at = sorted(range(len(found.columns)), key=lambda i: found.columns[i])
    return [found.columns[i] for i in at], sorted(tuple(cell(r[i]) for i in at) for r in found.fetchall())
