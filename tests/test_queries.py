"""Every registered query against its SQL on whole tables (see tools/check.py)."""

import duckdb
import pytest

from driver_queries import load
from driver_queries.base import TABLES
from tools.check import rows_of

QUERIES, ORACLES = load()
# building these plans takes long; tools/check.py covers them at every scale
FAST = ["domain_list", "receipt_scan", "scores", "canonical", "pages", "rerun_slice", "run_counters", "soft404", "retry_after",
        "ordered_merge", "payment_hints", "product_facts", "candidate_rank", "best_catalog", "stream_throughput"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    rel = duck.execute(ORACLES[name])
    columns = [d[0] for d in rel.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, rel.fetchall())


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 85
