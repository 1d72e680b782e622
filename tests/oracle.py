"""Spark results against DuckDB SQL on the same files."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def plain(v):
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in v.items())
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return bytes(v) if isinstance(v, bytearray) else v


def both(df, con, sql):
    cols = sorted(df.columns)
    ours = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    theirs = sorted(repr(tuple(plain(r[names.index(c)]) for c in cols)) for r in cur.fetchall())
    return ours, theirs
