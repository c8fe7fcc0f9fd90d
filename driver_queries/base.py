"""Registry and adapters: the driver tables seen as fetch, receipt and domain logs."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signpost.session import prepare

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(prepare(spark), sf)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def run_sql(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """Portable SQL over the driver tables it names."""
    for name in TABLES:
        if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql, re.IGNORECASE):
            table(spark, sf, name).createOrReplaceTempView(name)
    return spark.sql(sql)


def spread_out(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores: the driver tables come as one small file, and the work per row is CPU-heavy."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


# One receipt per event, in append order.
RECEIPT_LOG = """
SELECT event_id AS pos,
       concat('site', CAST(user_id AS STRING), '-', CAST(day(ts) AS STRING), '.example') AS domain,
       CASE WHEN user_id % 10 = 0 THEN NULL ELSE CAST(user_id AS INT) END AS rank,
       ts,
       CASE event_type WHEN 'purchase' THEN 'machine_payable' WHEN 'signup' THEN 'callable_surface'
            WHEN 'click' THEN 'catalog_surface' WHEN 'view' THEN 'ai_readable' ELSE 'unreachable' END AS label,
       event_id % 2 = 0 AS robots_present, event_id % 3 = 0 AS sitemap_present,
       event_type IN ('view', 'purchase') AS llms_present, event_id % 5 = 0 AS llms_full_present,
       event_type IN ('signup', 'purchase') AS openapi_present, event_id % 7 = 0 AS agent_present,
       event_id % 11 = 0 AS agent_card_present, event_id % 13 = 0 AS ucp_present,
       event_id % 17 = 0 AS commerce_present, event_id % 19 = 0 AS x402_present,
       event_type IN ('click', 'purchase') AS products_present,
       event_id % 23 = 0 AS has_sample_offers, event_id % 29 = 0 AS has_sample_products,
       event_type = 'purchase' AND event_id % 4 = 0 AS verified_payment_surface,
       CASE WHEN event_type = 'purchase' THEN 'x402' END AS payment_surface,
       CASE WHEN event_id % 4 = 1 THEN 0 ELSE CAST(floor(value) AS INT) END AS product_count,
       CASE WHEN event_id % 8 = 1 THEN CAST(event_id % 5 AS INT) END AS offer_count,
       CASE WHEN event_id % 6 = 0 THEN 1 ELSE 0 END AS priced_action_count,
       CASE event_id % 4 WHEN 0 THEN 'payment_challenge' WHEN 1 THEN 'catalog_only' WHEN 2 THEN 'unknown' ELSE 'read_only' END AS purchase_boundary,
       CASE event_id % 3 WHEN 0 THEN 'token_required' WHEN 1 THEN 'unknown' ELSE 'human_checkout' END AS control_boundary,
       event_id % 9 = 0 AS crypto_only,
       (event_type <> 'error' OR event_id % 5 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0
        OR event_id % 17 = 0 OR event_id % 19 = 0) AS is_interesting
FROM events
"""

# One captured response per event.
FETCH_LOG = """
SELECT event_id AS pos,
       concat('site', CAST(user_id AS STRING), '.example') AS domain,
       CAST(event_id % 2 AS INT) + 1 AS attempt,
       CASE event_id % 8 WHEN 0 THEN 'homepage' WHEN 1 THEN 'robots_txt' WHEN 2 THEN 'sitemap_xml'
            WHEN 3 THEN 'llms_txt' WHEN 4 THEN 'well_known_commerce' WHEN 5 THEN 'openapi_json'
            WHEN 6 THEN 'x402_json' ELSE 'products_json' END AS probe_key,
       CASE WHEN event_type = 'view' THEN 200 WHEN event_type = 'purchase' THEN 200
            WHEN event_type = 'click' THEN 404 WHEN event_type = 'signup' THEN 402
            WHEN event_id % 3 = 0 THEN 429 WHEN event_id % 3 = 1 THEN 503 END AS http_status,
       CASE WHEN event_type = 'error' AND event_id % 3 = 2 THEN 'timeout' END AS error,
       CASE WHEN event_id % 11 = 0 THEN 'https://login.idp.example/'
            ELSE concat('https://site', CAST(user_id AS STRING), '.example/') END AS final_url,
       concat('https://site', CAST(user_id AS STRING), '.example/') AS requested_url,
       CASE WHEN event_id % 7 = 0 THEN '' ELSE props END AS body,
       CASE event_id % 5 WHEN 0 THEN '120' WHEN 1 THEN 'Sun, 14 Jan 2024 12:00:00 GMT'
            WHEN 2 THEN 'soon' WHEN 3 THEN CAST(event_id % 50 AS STRING) END AS retry_after,
       CASE event_id % 4 WHEN 0 THEN 'Application/JSON; charset=utf-8' WHEN 1 THEN 'text/plain'
            WHEN 2 THEN ' text/HTML ;x' END AS content_type,
       ts
FROM events
"""

# The status every response of FETCH_LOG ends with when its validator accepts any body.
STATUS_OF_FETCH = """
CASE WHEN probe_key <> 'homepage' AND final_url LIKE 'https://login.%' THEN 'gated'
     WHEN http_status = 404 THEN 'missing'
     WHEN http_status = 429 THEN 'rate_limited'
     WHEN http_status IS NULL AND error IS NOT NULL THEN 'error'
     WHEN http_status IS NULL THEN 'http_error'
     WHEN NOT (http_status = 200 OR (http_status = 402 AND probe_key IN ('well_known_commerce', 'x402_json'))) THEN 'http_error'
     WHEN probe_key NOT IN ('homepage', 'x402_json') AND body = '' THEN 'invalid'
     ELSE 'valid' END
"""

# Offers as products, one product variant per line item.
VARIANT_LOG = """
SELECT l_orderkey AS doc_id, l_partkey AS product_id, l_suppkey AS supplier_id, l_linenumber AS variant_pos,
       CASE l_returnflag WHEN 'A' THEN 'JPY' WHEN 'N' THEN 'USD' ELSE 'KWD' END AS currency,
       CAST(round(l_extendedprice) AS BIGINT) AS minor_amount,
       l_linestatus = 'O' AS available
FROM lineitem
"""
