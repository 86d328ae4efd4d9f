"""Comparison of a query's rows with its DuckDB SQL."""

import datetime
import math
import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    """A value that compares alike from both engines."""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def differences(df, sql, sf_dir):
    """Rows that only one side has, and whether the columns agree."""
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = Counter(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in cur.fetchall())
    ours = Counter(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    return sorted(names) == sorted(df.columns), ours - theirs, theirs - ours
