"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"create view {name} as select * from '{path}'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple((type(r[i]).__name__, str(r[i])) for i in order) for r in rows)


def difference(df, con, sql):
    """None when both results agree, else a short account of how they differ."""
    got = df.collect()
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    want = rel.fetchall()
    mine, theirs = rows_of(df.columns, [tuple(r) for r in got]), rows_of(rel.columns, want)
    if mine == theirs:
        return None
    only_mine = [r for r in mine if r not in set(theirs)][:2]
    only_theirs = [r for r in theirs if r not in set(mine)][:2]
    return f"{len(mine)} rows vs {len(theirs)}; only here: {only_mine}; only there: {only_theirs}"
