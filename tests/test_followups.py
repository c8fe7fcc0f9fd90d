import json

from pyspark.sql import functions as F

from driver_queries.followups import follow_fetches
from signpost.plans import followups
from signpost.plans.crawl import outcomes_from_fetches, verdicts_from_fetches
from signpost.session import stored
from signpost.sources.fetches import request_id, with_request_id
from tests.helpers import fetches


def test_request_ids_tell_requests_apart(spark):
    rows = [("a", "GET", "u", None), ("a", "POST", "u", None), ("a", None, "u", None), ("a", "get", "u", None), ("a", "GET", "u", ""), ("b", "GET", "u", None), ("a", "GET", "v", None)]
    df = spark.createDataFrame(rows, "k string, m string, u string, n string")
    ids = [r[0] for r in df.select(request_id(*[F.col(c) for c in "kmun"])).collect()]
    assert ids[0] == ids[2] == ids[3] and len(set(ids)) == 5
    logged = spark.createDataFrame([("a", "u", "own"), ("a", "u", None)], "probe_key string, requested_url string, request_id string")
    assert [r.request_id for r in with_request_id(logged).collect()] == ["own", ids[0]]


def test_patched_facts(spark):
    row = spark.range(1).select(followups.patched(F.parse_json(F.lit('{"a":1,"b":[2],"c":"x"}')), {"a": F.lit(5), "b": F.lit(None).cast("string"), "d": F.array(F.lit("y"))}).alias("f"))
    assert json.loads(row.select(F.to_json("f")).first()[0]) == {"a": 5, "c": "x", "d": ["y"]}


def test_receipts_without_follow_ups_pass_through(spark, sf):
    fetches = follow_fetches(spark, sf).where(F.col("probe_key").isin("homepage", "products_json") & F.col("domain").isin("shop1.example", "shop2.example"))
    first = stored(outcomes_from_fetches(fetches), "outcomes")
    rows = followups.with_follow_ups(first, fetches)
    assert sorted((r.domain, r.probe_key, r.status) for r in rows.collect()) == sorted((r.domain, r.probe_key, r.status) for r in first.collect())


def test_the_last_capture_of_a_request_counts_and_unasked_ones_come_last(spark):
    agent = '{"name":"A","discovery":{"x402":"https://pay.example/x402"}}'
    good, bad = '{"x402Version":1,"accepts":[{"network":"base","asset":"usdc"}]}', '{"name":"x"}'
    rows = [
        ("one.example", "well_known_agent_json", "https://one.example/.well-known/agent.json", agent, 0),
        ("one.example", "remote_x402", "https://pay.example/x402", bad, 1), ("one.example", "remote_x402", "https://pay.example/x402", good, 2),
        ("one.example", "remote_x402", "https://nobody.example/x402", bad, 9),
        ("two.example", "remote_x402", "https://nobody.example/x402", good, 1),
    ]
    log = spark.createDataFrame(rows, "domain string, probe_key string, requested_url string, body string, seq int").select(
        "domain", F.lit(1).alias("attempt"), "probe_key", F.lit(None).cast("string").alias("control_group"), "requested_url", F.lit("GET").alias("request_method"),
        F.col("requested_url").alias("final_url"), F.lit(200).alias("http_status"), F.lit("application/json").alias("content_type"), F.encode("body", "UTF-8").alias("body"),
        F.lit(False).alias("truncated"), F.lit(None).cast("string").alias("error"), F.create_map().cast("map<string,string>").alias("headers"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("seq")).alias("fetched_at"), F.octet_length("body").cast("long").alias("byte_count"), F.sha2(F.encode("body", "UTF-8"), 256).alias("body_sha256"))
    first = stored(outcomes_from_fetches(log), "outcomes")
    got = {(r.domain, r.probe_key): (r.path, r.status) for r in followups.with_follow_ups(first, log).collect()}
    assert got["one.example", "remote_x402"] == ("https://pay.example/x402", "valid")
    assert got["two.example", "remote_x402"] == ("https://nobody.example/x402", "valid")


def test_bodies_of_one_file_are_judged_by_several_tasks(spark):
    log = fetches(spark, [{"domain": f"d{i}.example", "probe_key": "robots_txt", "content_type": "text/plain", "body": "User-agent: *"} for i in range(64)]).coalesce(1)
    judged = verdicts_from_fetches(log)
    assert judged.where("verdict = 'valid'").count() == 64
    assert len([f for f in judged.inputFiles() if "/verdicts/" in f]) > 1
