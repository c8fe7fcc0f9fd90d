"""Comparison of a registered query with its SQL on whole tables."""

import duckdb

from signpost.llm.queries import ORACLES, QUERIES
from tools.check import rows_of

TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]


def same_as_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    rel = con.execute(ORACLES[name])
    columns = [d[0] for d in rel.description]
    assert sorted(columns) == sorted(df.columns)
    got, want = rows_of(df.columns, df.collect()), rows_of(columns, rel.fetchall())
    assert len(got) == len(want) and got
    assert got == want
