from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from signpost import values as V
from signpost.operators import outcomes as O
from signpost.operators.facts.registry import VALIDATORS, register_fact_job
from signpost.plans.crawl import _over_cores, outcomes_from_fetches, receipts_from_outcomes
from signpost.session import OPEN_FILES, cut, stored
from tests.helpers import fetches

AT = datetime(2024, 1, 1)


def ladder(spark, *rows):
    df = fetches(spark, [{"fetched_at": AT, **r} for r in rows])
    return O.prepared(df, O.control_signatures(df))


RUNGS = [
    ({"probe_key": "robots_txt", "final_url": "https://login.b.example/x"}, "gated"),
    ({"probe_key": "homepage", "final_url": "https://login.b.example/x", "body": "x"}, None),
    ({"probe_key": "robots_txt", "final_url": "https://android.b.example/x"}, "gated"),
    ({"http_status": 404}, "missing"),
    ({"http_status": 429, "headers": {"Retry-After": "7"}}, "rate_limited"),
    ({"http_status": None, "error": "timeout"}, "error"),
    ({"http_status": None}, "http_error"),
    ({"http_status": 500}, "http_error"),
    ({"probe_key": "robots_txt", "body": ""}, "invalid"),
    ({"probe_key": "x402_json", "body": "", "http_status": 402}, None),
    ({"probe_key": "well_known_commerce", "body": "x", "http_status": 402}, None),
    ({"probe_key": "robots_txt", "body": "x", "http_status": 402}, "http_error"),
    ({"probe_key": "payment_probe", "body": "", "http_status": 503}, None),
]


def test_status_ladder(spark):
    rows = ladder(spark, *[{**row, "domain": f"d{i}.example", "requested_url": "https://a.example/", "final_url": row.get("final_url")} for i, (row, _) in enumerate(RUNGS)])
    got = {r.domain: r for r in rows.select("domain", "status", "detail").collect()}
    assert [got[f"d{i}.example"].status for i in range(len(RUNGS))] == [status for _, status in RUNGS]
    assert got["d4.example"].detail == "HTTP 429 (Retry-After: 7s)"


def test_soft404(spark):
    small, large = b"s" * 100, b"l" * 5_000
    rows = []
    for domain, body, kind in [("same", small, "Text/Plain; x"), ("large", large, "text/plain"), ("kind", small, "text/html"), ("other", b"o", "text/plain")]:
        rows.append({"domain": domain, "probe_key": "robots_txt", "content_type": "text/plain", "body": body})
        rows.append({"domain": domain, "probe_key": "control:text", "content_type": kind, "body": small if domain == "other" else body})
    got = {r.domain: r.status for r in ladder(spark, *rows).collect()}
    assert got == {"same": "fallback", "large": None, "kind": None, "other": None}


def test_cut_control_matches_no_page(spark):
    limit, rows = V.CONTROL_MAX_BYTES, []
    for domain, more in [("equal", b""), ("longer", b"!")]:
        rows.append({"domain": domain, "probe_key": "robots_txt", "body": b"x" * limit})
        rows.append({"domain": domain, "probe_key": "control:text", "body": b"x" * limit + more})
    assert {r.domain: r.status for r in ladder(spark, *rows).collect()} == {"equal": "fallback", "longer": None}


@pytest.mark.parametrize("value,seconds", [
    ("120", 120), (" 5 ", 5), ("Mon, 01 Jan 2024 00:01:40 GMT", 100), ("Sun, 31 Dec 2023 00:00:00 GMT", 0),
    ("Mon, 01 Jan 2024 01:00:30 +0100", 30), ("Mon, 01 Jan 2024 00:01:40", None), ("soon", None), ("", None), (None, None),
])
def test_retry_after(spark, value, seconds):
    df = spark.createDataFrame([(value, AT)], "v string, t timestamp")
    assert df.select(O.retry_after(F.col("v"), F.col("t")).alias("s")).first().s == seconds


def test_whole_crawl_side(spark):
    rows = [
        {"probe_key": "homepage", "content_type": "text/html", "body": "<html><title> A  shop </title></html>"},
        {"probe_key": "robots_txt", "content_type": "text/plain", "body": "User-agent: *"},
        {"probe_key": "sitemap_xml", "content_type": "text/xml", "body": "<urlset/>"},
        {"probe_key": "llms_txt", "content_type": "text/plain", "body": "# docs"},
        {"probe_key": "x402_json", "http_status": 402, "body": '{"x402Version":1,"accepts":[{"network":"base","asset":"usdc"}]}'},
        {"probe_key": "products_json", "body": '{"products":[{"title":"P","handle":"p","variants":[{"price":"2.50"}]}]}'},
        {"probe_key": "robots_txt", "domain": "b.example", "http_status": 429, "headers": {"retry-after": "9"}},
        {"probe_key": "robots_txt", "domain": "b.example", "attempt": 2, "content_type": "text/plain", "body": "User-agent: x"},
        {"probe_key": "homepage", "domain": "c.example", "http_status": None, "error": "timeout"},
    ]
    df = fetches(spark, [{"fetched_at": AT, **r} for r in rows])
    jobs = {name: VALIDATORS[name] for name in ("homepage", "robots", "sitemap", "llms", "x402", "products")}
    found = cut(outcomes_from_fetches(df, jobs))
    status = {(r.domain, r.attempt, r.probe_key): r.status for r in found.collect()}
    assert status[("a.example", 1, "x402_json")] == "valid" and status[("b.example", 1, "robots_txt")] == "rate_limited"
    got = {r.domain: r for r in receipts_from_outcomes(found).collect()}
    a = got["a.example"]
    assert (a.label, a.title) == ("machine_payable", "A shop")
    assert a.tags == ["ai_readable", "callable_surface", "catalog_surface", "crawl_basics", "machine_payable"]
    doc = a.aggregates.toPython()
    assert doc["payment_surface"] == "x402" and doc["product_count"] == 1 and doc["sample_products"][0]["product_url"] == "https://a.example/products/p"
    assert (got["b.example"].label, got["b.example"].attempt) == ("rate_limited", 1)
    assert got["c.example"].label == "unreachable"


def test_own_fact_job(spark):
    def shout(rows):
        return rows.withColumns({"is_valid": F.lit(True), "detail": F.lit("ok"), "facts": F.struct(F.upper(F.decode("body", "UTF-8")).alias("text"))})

    saved = VALIDATORS["robots"]
    register_fact_job("robots", shout)
    register_fact_job("humans", shout, {"humans_txt": ("/humans.txt", 100, None)}, statuses=(200, 203))
    try:
        df = fetches(spark, [
            {"fetched_at": AT, "probe_key": "robots_txt", "body": "hi"}, {"fetched_at": AT, "probe_key": "humans_txt", "body": "ho", "http_status": 203},
            {"fetched_at": AT, "probe_key": "nobody_knows", "body": "x"}])
        got = {r.probe_key: r for r in outcomes_from_fetches(df, {n: VALIDATORS[n] for n in ("robots", "humans")}).collect()}
        assert got["robots_txt"].status == "valid" and got["robots_txt"].facts.toPython() == {"text": "HI"}
        assert got["humans_txt"].status == "valid" and got["humans_txt"].path == "/humans.txt"
        assert got["nobody_knows"].status == "unknown"
    finally:
        VALIDATORS["robots"] = saved
        del VALIDATORS["humans"]
    with pytest.raises(ValueError, match="needs the probes"):
        register_fact_job("other", shout)


def test_skipped_probes_and_crawl_time_reach_the_receipt(spark):
    df = fetches(spark, [{"fetched_at": AT, "probe_key": "robots_txt", "content_type": "text/plain", "body": "User-agent: *"}])
    receipt = receipts_from_outcomes(outcomes_from_fetches(df)).first()
    assert receipt.probes.products_json.status == "skipped" and receipt.probes.robots_txt.status == "valid"
    assert receipt.probes.api_products is None and receipt.crawled_at.endswith("+00:00")


def test_crawl_plan_scans_the_log_twice_and_joins_once(spark, tmp_path):
    path = str(tmp_path / "log")
    fetches(spark, [{"fetched_at": AT, "probe_key": "robots_txt", "body": "User-agent: *"}]).write.parquet(path)
    plan = outcomes_from_fetches(spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    # the other scan fed the stored ladder
    locations = outcomes_from_fetches(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert locations.count("file:" + path) + locations.count(path + "]") <= 2


def test_bodies_are_not_sorted_on_their_way(spark, monkeypatch):
    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append(spark.conf.get(OPEN_FILES[0], None)), write(self, path))[1])
    before = spark.conf.get(OPEN_FILES[0], None)
    rows = spark.range(0, 400, 1, 3).selectExpr("id", "id % 40 AS folder")  # more folders than open files
    back = stored(rows, "folders", ["folder"])
    assert seen == [OPEN_FILES[1]] and spark.conf.get(OPEN_FILES[0], None) == before
    assert sorted((r.id, r.folder) for r in back.collect()) == [(i, i % 40) for i in range(400)]
    captures = spark.range(0, 9, 1, 1).selectExpr("string(id) AS domain", "1 AS attempt", "'p' AS probe_key", "'r' AS request_id", "current_timestamp() AS fetched_at")
    dealt = _over_cores(captures)
    assert "RoundRobin" not in dealt._jdf.queryExecution().toString() and dealt.count() == 9
