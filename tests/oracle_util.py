"""Spark-vs-DuckDB comparison used by the tests (same normalisation as the
driver's check: columns sorted by name, rows order-insensitive)."""

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted(tuple(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(df, con, sql):
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    d_cols, d_rows = canon([d[0] for d in res.description], res.fetchall())
    return s_cols == d_cols and s_rows == d_rows, (s_cols, d_cols, len(s_rows), len(d_rows))
