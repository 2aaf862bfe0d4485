"""Runs a query in Spark and its SQL in DuckDB and compares names, types and rows."""

import decimal
import glob
import os

import duckdb

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


def connect(folder):
    c = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def norm(v):
    if isinstance(v, float):
        return round(v, 5)
    return float(v) if isinstance(v, decimal.Decimal) else v


def check(spark, con, folder, query, sql):
    df = query(spark, folder)
    rel = con.sql(sql)
    cols = list(rel.columns)
    assert sorted(df.columns) == sorted(cols)
    for name, kind in df.dtypes:
        assert KINDS.get(kind, kind) == str(rel.types[cols.index(name)]), name
    a = sorted((tuple(norm(r[k]) for k in sorted(cols)) for r in df.toArrow().to_pylist()), key=repr)
    b = sorted((tuple(norm(v) for _, v in sorted(zip(cols, row))) for row in rel.fetchall()), key=repr)
    assert a == b
