"""Rows of a Spark query against rows of its DuckDB SQL."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.execute(f"create view {t} as select * from read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return c


def same(df, con, sql):
    got = [r.asDict(True) for r in df.collect()]
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = [dict(zip(names, r, strict=True)) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(names)
    key = lambda r: repr(sorted(r.items()))
    assert sorted(map(key, got)) == sorted(map(key, want))
