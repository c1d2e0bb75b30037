"""Rows of a Spark query against rows of DuckDB SQL, order aside."""

import datetime
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def plain(x):
    if isinstance(x, (list, tuple)):
        return str([plain(v) for v in x])
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return repr(x) if isinstance(x, float) else str(x)


def same(df, con, sql):
    names = sorted(df.columns)
    found = con.execute(sql)
    order = [c[0] for c in found.description]
    assert sorted(order) == names
    want = sorted(tuple(plain(r[order.index(c)]) for c in names) for r in found.fetchall())
    got = sorted(tuple(map(plain, r)) for r in df.select(*names).collect())
    assert got == want
    return len(got)
