"""Spark rows against DuckDB rows of the same tables, as the driver compares them."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(df):
    cols = sorted(df.columns)
    none = lambda x: None if x is None or (isinstance(x, float) and math.isnan(x)) else x
    return cols, sorted((tuple(none(x) for x in r) for r in df[cols].astype(object).itertuples(index=False)), key=repr)


def same(spark, con, query, sql, sf_dir):
    got, want = rows(query(spark, sf_dir).toPandas()), rows(con.execute(sql).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
