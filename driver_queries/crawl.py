"""The crawl chain end to end: a fetch log on disk to outcomes, receipts, positives, evidence and the export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driver_queries.base import FETCH_LOG, query, run_sql, table
from signpost.operators.facts.registry import VALIDATORS, Validator
from signpost.plans.crawl import evidence_of, outcomes_from_fetches, positives_of, receipts_from_fetches
from signpost.plans.export import export_public
from signpost.session import scratch_path, stored
from signpost.sources import receipts as R
from signpost.sources.fetches import read_fetches
from signpost.sources.sinks import write_rerun_list

# The fetch log with bodies a validator takes or rejects, and control captures for a tenth of the domains.
GOOD_BODY = """
CASE probe_key WHEN 'homepage' THEN '<html><title>A shop</title></html>' WHEN 'robots_txt' THEN 'User-agent: *' WHEN 'sitemap_xml' THEN '<urlset></urlset>'
  WHEN 'llms_txt' THEN '# docs' WHEN 'well_known_commerce' THEN '{"offers":[{"price":"1","currency":"USD"}],"a":{"b":1,"b":2}}'
  WHEN 'openapi_json' THEN '{"openapi":"3.0.0","paths":{"/a":{"get":{"summary":"x","summary":"y"}}},"x":NaN}' WHEN 'x402_json' THEN '{"x402Version":1,"accepts":[{"network":"base","asset":"usdc"}]}'
  ELSE '{"products":[{"title":"P","handle":"p","variants":[{"price":"2.50"}]}]}' END
"""
BAD_BODY = """
CASE probe_key WHEN 'homepage' THEN '' WHEN 'robots_txt' THEN '<html><body>no</body></html>' WHEN 'sitemap_xml' THEN '<html><body>no</body></html>'
  WHEN 'llms_txt' THEN '<html><body>no</body></html>' WHEN 'well_known_commerce' THEN '{"k":1}'
  WHEN 'openapi_json' THEN '{"openapi":"3.0.0","paths":{"/a":{}}} junk }' WHEN 'x402_json' THEN '{"name":"x"}' ELSE '{"products":[{"title":"P"}]} {}' END
"""
CRAWL_LOG = f"""
SELECT domain, attempt, probe_key, http_status, error, final_url, requested_url, retry_after, ts, pos,
       CASE probe_key WHEN 'homepage' THEN 'text/html' WHEN 'robots_txt' THEN 'text/plain' WHEN 'sitemap_xml' THEN 'text/plain' WHEN 'llms_txt' THEN 'text/plain' ELSE 'application/json' END AS content_type,
       CASE WHEN pos % 7 = 0 THEN '' WHEN pos % 3 = 0 THEN {BAD_BODY} ELSE {GOOD_BODY} END AS body
FROM ({FETCH_LOG}) f
"""
CONTROL_LOG = f"""
SELECT DISTINCT domain, attempt, 'control:text' AS probe_key, 200 AS http_status, CAST(NULL AS STRING) AS error, requested_url AS final_url, requested_url,
       CAST(NULL AS STRING) AS retry_after, CAST('2023-12-31 00:00:00' AS TIMESTAMP) AS ts, CAST(-1 AS BIGINT) AS pos, 'text/plain' AS content_type, 'User-agent: *' AS body
FROM (SELECT domain, attempt, concat('https://', domain, '/') AS requested_url FROM ({FETCH_LOG}) f WHERE domain LIKE '%3.example') d
"""
# status by the rules, written out: ladder, control match, then what the body says
CRAWL_STATUS = """
CASE WHEN probe_key <> 'homepage' AND final_url LIKE 'https://login.%' THEN 'gated'
     WHEN http_status = 404 THEN 'missing'
     WHEN http_status = 429 THEN 'rate_limited'
     WHEN http_status IS NULL AND error IS NOT NULL THEN 'error'
     WHEN http_status IS NULL THEN 'http_error'
     WHEN NOT (http_status = 200 OR (http_status = 402 AND probe_key IN ('well_known_commerce', 'x402_json'))) THEN 'http_error'
     WHEN probe_key NOT IN ('homepage', 'x402_json') AND body = '' THEN 'invalid'
     WHEN http_status = 200 AND probe_key IN ('robots_txt', 'llms_txt') AND body = 'User-agent: *' AND domain LIKE '%3.example' THEN 'fallback'
     WHEN probe_key = 'homepage' THEN CASE WHEN body LIKE '<html>%' THEN 'valid' ELSE 'invalid' END
     WHEN probe_key = 'robots_txt' THEN CASE WHEN body LIKE 'User-agent:%' THEN 'valid' ELSE 'invalid' END
     WHEN probe_key = 'sitemap_xml' THEN CASE WHEN body LIKE '<urlset%' THEN 'valid' ELSE 'invalid' END
     WHEN probe_key = 'llms_txt' THEN CASE WHEN body LIKE '#%' THEN 'valid' ELSE 'invalid' END
     WHEN probe_key = 'well_known_commerce' THEN CASE WHEN body LIKE '%"offers"%' THEN 'valid' ELSE 'invalid' END
     WHEN probe_key = 'openapi_json' THEN CASE WHEN body LIKE '%"paths"%' AND body NOT LIKE '%junk%' THEN 'valid' ELSE 'invalid' END
     WHEN probe_key = 'x402_json' THEN CASE WHEN body LIKE '%"accepts"%' THEN 'valid' ELSE 'invalid' END
     ELSE CASE WHEN body LIKE '%"variants"%' THEN 'valid' ELSE 'invalid' END END
"""
CRAWL_OUTCOMES = f"SELECT domain, attempt, probe_key, CAST(epoch_us(ts) AS BIGINT) AS fetched, {CRAWL_STATUS} AS status FROM ({CRAWL_LOG}) c"


def crawl_fetches(spark, sf) -> DataFrame:
    """The log written as Parquet and read by the engine's own reader."""
    rows = run_sql(spark, sf, f"SELECT * FROM ({CRAWL_LOG}) c").unionByName(run_sql(spark, sf, CONTROL_LOG))
    raw = rows.select(
        "domain", "attempt", "probe_key", F.lit(None).cast("string").alias("control_group"), "requested_url", F.lit("GET").alias("request_method"), "final_url",
        "http_status", "content_type", F.encode("body", "UTF-8").alias("body"), F.lit(False).alias("truncated"), "error",
        F.map_filter(F.create_map(F.lit("Retry-After"), F.col("retry_after")), lambda k, v: v.isNotNull()).alias("headers"), F.col("ts").cast("timestamp").alias("fetched_at"))
    path = scratch_path(spark, "fetches")
    raw.write.parquet(path)
    return read_fetches(spark, path)


def crawl_columns(outcomes: DataFrame) -> DataFrame:
    return outcomes.select("domain", "attempt", "probe_key", F.unix_micros("fetched_at").alias("fetched"), "status")


@query("crawl_outcomes", CRAWL_OUTCOMES)
def crawl_outcomes(spark, sf):
    return crawl_columns(outcomes_from_fetches(crawl_fetches(spark, sf)))


@query("status_ladder", f"SELECT probe_key, status, count(*) AS n FROM ({CRAWL_OUTCOMES}) o GROUP BY ALL")
def status_ladder(spark, sf):
    return outcomes_from_fetches(crawl_fetches(spark, sf)).groupBy("probe_key", "status").agg(F.count(F.lit(1)).alias("n"))


# the last capture of each probe counts; of several attempts the one with the best label, then more valid, fewer limited probes, then the earlier
LAST_PROBES = f"""
SELECT domain, attempt, probe_key, arg_max(status, fetched) AS status, max(fetched) AS fetched FROM ({CRAWL_OUTCOMES}) o GROUP BY ALL
"""
_HAS = "bool_or(probe_key = '{0}' AND status = 'valid')"
ATTEMPTS = f"""
SELECT domain, attempt, CAST(max(fetched) AS BIGINT) AS crawled, count(*) FILTER (WHERE status = 'valid') AS valid_count, count(*) FILTER (WHERE status = 'rate_limited') AS rate_limited_count,
       17 - count(*) AS skipped_count,
       coalesce(bool_or(status = 'valid') FILTER (WHERE probe_key IN ('llms_txt', 'well_known_commerce', 'openapi_json', 'x402_json', 'products_json')), false) AS is_interesting,
       CASE WHEN {_HAS.format('x402_json')} THEN 8 WHEN {_HAS.format('well_known_commerce')} THEN 7 WHEN {_HAS.format('openapi_json')} THEN 6 WHEN {_HAS.format('products_json')} THEN 5
            WHEN {_HAS.format('llms_txt')} THEN 4 WHEN bool_or(status = 'rate_limited') THEN 3 WHEN bool_or(probe_key = 'homepage' AND status = 'error') THEN 0
            WHEN {_HAS.format('robots_txt')} AND {_HAS.format('sitemap_xml')} THEN 2 ELSE 1 END AS priority
FROM ({LAST_PROBES}) p GROUP BY domain, attempt
"""
BEST_ATTEMPTS = f"SELECT * FROM ({ATTEMPTS}) a QUALIFY row_number() OVER (PARTITION BY domain ORDER BY priority DESC, valid_count DESC, rate_limited_count, attempt) = 1"
CRAWL_RECEIPTS = f"SELECT domain, CAST(attempt AS INT) AS attempt, crawled, valid_count, rate_limited_count, skipped_count, is_interesting FROM ({BEST_ATTEMPTS}) b"


@query("crawl_receipts", CRAWL_RECEIPTS)
def crawl_receipts(spark, sf):
    receipts = receipts_from_fetches(crawl_fetches(spark, sf))
    skipped = F.size(F.filter(F.array("probes.*"), lambda p: p["status"] == "skipped"))
    from signpost.plans.crawl import with_signal

    return with_signal(receipts).select(
        "domain", F.col("attempt").cast("int").alias("attempt"), F.unix_micros(F.to_timestamp("crawled_at")).alias("crawled"), F.col("valid_count").cast("bigint").alias("valid_count"),
        F.col("rate_limited_count").cast("bigint").alias("rate_limited_count"), skipped.cast("bigint").alias("skipped_count"), "is_interesting")


@query(
    "crawl_retries",
    f"""SELECT domain, count(DISTINCT attempt) AS attempts FROM ({CRAWL_OUTCOMES}) o GROUP BY domain HAVING count(DISTINCT attempt) > 1""",
)
def crawl_retries(spark, sf):
    doc = F.col("aggregates")
    rows = receipts_from_fetches(crawl_fetches(spark, sf))
    found = rows.select("domain", F.try_variant_get(doc, "$.rate_limit_retry_attempt_count", "bigint").alias("attempts"))
    return found.where("attempts IS NOT NULL")


@query(
    "crawl_to_export",
    f"""SELECT domain, is_interesting AS has_detail, CASE WHEN is_interesting AND EXISTS (SELECT 1 FROM ({LAST_PROBES}) p WHERE p.domain = r.domain AND p.attempt = r.attempt AND probe_key = 'llms_txt' AND status = 'valid')
             THEN 6 END::BIGINT AS llms_bytes FROM ({CRAWL_RECEIPTS}) r""",
)
def crawl_to_export(spark, sf):
    """Fetch log to receipt log, positives, evidence and the published index, through files all the way."""
    fetches = crawl_fetches(spark, sf)
    log, out = scratch_path(spark, "receipts"), scratch_path(spark, "public")
    receipts = stored(receipts_from_fetches(fetches), "receipts-of-crawl")
    R.write_receipts(receipts, log)
    evidence = stored(evidence_of(receipts, fetches), "evidence")
    export_public(spark, log, positives_of(receipts), evidence, out)
    index = spark.read.parquet(f"{out}/index")
    sizes = spark.read.parquet(f"{out}/evidence").where("key LIKE '%llms.txt'")
    return index.select("domain", F.col("receipt_r2_key").isNotNull().alias("has_detail"), "llms_r2_key").join(
        sizes.select(F.col("key").alias("llms_r2_key"), F.octet_length("body").cast("bigint").alias("llms_bytes")), "llms_r2_key", "left").drop("llms_r2_key")


@query(
    "own_validator",
    f"""SELECT domain, CAST(epoch_us(ts) AS BIGINT) AS fetched, CASE WHEN http_status = 200 THEN CASE WHEN length(body) > 20 THEN 'valid' ELSE 'invalid' END
             WHEN http_status = 404 THEN 'missing' WHEN http_status = 429 THEN 'rate_limited' WHEN http_status IS NULL AND error IS NOT NULL THEN 'error' ELSE 'http_error' END AS status,
             CASE WHEN http_status = 200 THEN length(body) END::BIGINT AS length
        FROM ({CRAWL_LOG}) c WHERE probe_key = 'llms_txt' AND final_url NOT LIKE 'https://login.%' AND body <> ''""",
)
def own_validator(spark, sf):
    """A validator of the caller's with a probe the catalogue does not have."""

    def long_enough(rows: DataFrame) -> DataFrame:
        size = F.octet_length("body").cast("bigint")
        return rows.withColumns({"is_valid": size > 20, "detail": F.lit("measured"), "facts": F.struct(size.alias("length"))})

    own = {**VALIDATORS, "humans": Validator(long_enough, {"humans_txt": ("/humans.txt", 4096, None)})}
    renamed = F.when(F.col("probe_key") == "llms_txt", "humans_txt").otherwise(F.col("probe_key"))
    fetches = crawl_fetches(spark, sf).withColumn("probe_key", renamed)
    rows = outcomes_from_fetches(fetches, own).where("probe_key = 'humans_txt' AND status <> 'gated' AND byte_count > 0")
    length = F.try_variant_get("facts", "$.length", "bigint")
    return rows.select("domain", F.unix_micros("fetched_at").alias("fetched"), "status", length.alias("length"))


REJECTED = [
    ("well_known_agent_json", "application/json", """'{"zeta":1,"beta":2}'""", '{"top_level_keys":["beta","zeta"]}'),
    ("x402_json", "application/json", """'{"name":"x"}'""", '{"top_level_keys":["name"]}'),
    ("well_known_commerce", "application/json", """concat('{"k', n, '":1}')""", None),
    ("well_known_commerce", "text/plain", "'hello there'", '{"char_count":11}'),
    ("products_json", "application/json", """'{"products":[]}'""", '{"product_count":0}'),
    ("cart_json", "application/json", """concat('{"currency":"USD","pad":"', repeat('x', 17000), '"}')""", '{"truncated":true}'),
    ("well_known_agents_json", "application/json", "'[1'", None),
]


@query(
    "rejected_facts",
    "SELECT concat('shop', c_custkey, '.example') AS domain, 'invalid' AS status, CASE c_custkey % 7 "
    + " ".join(f"WHEN {i} THEN '{facts}'" for i, (*_, facts) in enumerate(REJECTED) if facts)
    + """ WHEN 2 THEN concat('{"top_level_keys":["k', c_custkey, '"]}') END AS facts FROM customer""",
)
def rejected_facts(spark, sf):
    """What is noted of documents that are no valid ones."""
    log = " UNION ALL ".join(
        f"SELECT n, concat('shop', n, '.example') AS domain, '{key}' AS probe_key, '{media}' AS content_type, {body} AS body FROM (SELECT c_custkey AS n FROM customer) c WHERE n % 7 = {i}"
        for i, (key, media, body, _) in enumerate(REJECTED))
    url = F.concat(F.lit("https://"), F.col("domain"), F.lit("/x"))
    raw = run_sql(spark, sf, log).select(
        "domain", F.lit(1).alias("attempt"), "probe_key", F.lit(None).cast("string").alias("control_group"), url.alias("requested_url"), F.lit("GET").alias("request_method"),
        url.alias("final_url"), F.lit(200).alias("http_status"), "content_type", F.encode("body", "UTF-8").alias("body"), F.lit(False).alias("truncated"), F.lit(None).cast("string").alias("error"),
        F.create_map().cast("map<string,string>").alias("headers"), F.lit("2024-01-01").cast("timestamp").alias("fetched_at"))
    path = scratch_path(spark, "rejected")
    raw.write.parquet(path)
    return outcomes_from_fetches(read_fetches(spark, path)).select("domain", "status", F.to_json("facts").alias("facts"))


# ---------------------------------------------------------------- sinks


@query(
    "receipt_sink",
    f"SELECT domain, valid_count FROM ({CRAWL_RECEIPTS}) r",
)
def receipt_sink(spark, sf):
    """Receipts written as a log and read again."""
    path = scratch_path(spark, "receipts")
    R.write_receipts(receipts_from_fetches(crawl_fetches(spark, sf)), path, max_records=20)
    valid = F.size(F.filter(F.array("probes.*"), lambda p: p["status"] == "valid"))
    return R.read_receipts(spark, path).select("domain", valid.cast("bigint").alias("valid_count"))


@query("rerun_sink", "SELECT concat(coalesce(CAST(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey END AS VARCHAR), ''), ',c', c_custkey, '.example') AS line FROM customer")
def rerun_sink(spark, sf):
    path = scratch_path(spark, "rerun")
    rank = F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey").cast("int"))
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("row_index"), rank.alias("rank"), F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(".example")).alias("domain"))
    write_rerun_list(rows, path)
    return spark.read.text(path).withColumnRenamed("value", "line")
