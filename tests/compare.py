"""Holds a query's rows against its SQL's, order aside."""

import glob
import os

import duckdb


def plain(v):
    if isinstance(v, float):
        return "null" if v != v else repr(round(v, 6) + 0.0)
    if v is None or str(v) == "<NA>":
        return "null"
    if hasattr(v, "__len__") and not isinstance(v, (str, dict, bytes)):
        return str([plain(x) for x in v])
    return str(v)


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(plain(v) for v in r) for r in df[cols].itertuples(index=False))


def same(spark, entry, name, sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    made, wanted = rows(entry.queries()[name](spark, sf_dir).toPandas()), rows(con.execute(entry.oracle_sql()[name]).df())
    assert made[0] == wanted[0]
    assert made[1] == wanted[1]
    return len(made[1])
