"""Comparison of a query's rows with its SQL on the same files."""

import decimal
import os

import duckdb


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return None if v != v else float(f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def sql_rows(sql, d):
    c = duckdb.connect()
    for f in os.listdir(d):
        path = f"{d}/{f}" + ("/*.parquet" if os.path.isdir(f"{d}/{f}") else "")
        c.execute(f"create view {f.split('.')[0]} as select * from '{path}'")
    q = c.execute(sql)
    names = [x[0] for x in q.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in q.fetchall()), key=repr)
