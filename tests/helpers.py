"""Results of a Spark query and of its SQL, in a form that can be compared."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SMALL = "/root/testdata/sf0.001"


def connection(sf_dir: str = SMALL):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return "NULL"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (float, np.floating)):
        return "NULL" if v != v else f"{float(v):.9g}"
    if isinstance(v, (int, np.integer)):
        return str(int(v))
    if isinstance(v, (list, np.ndarray)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


def of_spark(df):
    order = sorted(df.columns)
    return order, sorted(tuple(plain(r[c]) for c in order) for r in df.collect())


def of_sql(con, sql):
    frame = con.sql(sql).df()
    order = sorted(frame.columns)
    return order, sorted(tuple(plain(v) for v in r) for r in frame[order].astype(object).itertuples(index=False))
