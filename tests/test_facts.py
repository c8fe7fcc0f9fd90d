import base64
import json

import pytest
from pyspark.sql import functions as F

from signpost.functions import documents as D
from signpost.functions import urls as U
from signpost.operators.facts import catalog, commerce, contracts, hints, observed, texts
from tests.helpers import fetches, one


def run(spark, job, **row):
    if isinstance(row.get("body"), (dict, list)):
        row["body"] = json.dumps(row["body"])
    got = one(job(fetches(spark, [row])))
    return got["is_valid"], got["detail"], got["facts"]


def run_all(spark, job, *rows):
    """One plan for many documents: (is_valid, detail, facts) in order."""
    shaped = [{**r, "body": json.dumps(r["body"]) if isinstance(r.get("body"), (dict, list)) else r.get("body", ""), "attempt": i} for i, r in enumerate(rows)]
    got = sorted(job(fetches(spark, shaped)).collect(), key=lambda r: r["attempt"])
    assert len(got) == len(rows)
    return [(r["is_valid"], r["detail"], r["facts"].asDict(recursive=True) if r["facts"] is not None else None) for r in got]


_RESOLVED = {}


def resolved(spark, how):
    """All cases of a resolver in one plan."""
    if how not in _RESOLVED:
        cases = [m for t in (test_resolve, test_resolve_api_path) for mark in t.pytestmark for m in mark.args[1]]
        df = spark.createDataFrame([(b, c) for b, c, _ in cases], "b string, c string")
        _RESOLVED[how] = {(r.b, r.c): r.u for r in df.select("b", "c", how(F.col("b"), F.col("c")).alias("u")).collect()}
    return _RESOLVED[how]


@pytest.mark.parametrize("base,candidate,expected", [
    ("https://a.b/c/d?x=1", "e", "https://a.b/c/e"), ("https://a.b/c/d", "../e", "https://a.b/e"), ("https://a.b", "e/./f", "https://a.b/e/f"),
    ("https://a.b/c", "//h/i", "https://h/i"), ("https://a.b/c/d", "?q=2", "https://a.b/c/d?q=2"), ("https://a.b/c?z#y", "#f", "https://a.b/c?z#f"),
    ("https://a.b/c", "mailto:x@y", "mailto:x@y"), ("https://a.b/c", " /r ", "https://a.b/r"), ("https://a.b/c", "/../r/..", "https://a.b/"),
    (None, "/r", None), ("https://a.b", "  ", None), (None, "http://q", "http://q"), ("https://a.b/c/", "g//h", "https://a.b/c/g/h"),
])
def test_resolve(spark, base, candidate, expected):
    assert resolved(spark, U.resolve)[(base, candidate)] == expected


@pytest.mark.parametrize("base,candidate,expected", [
    ("https://a.b/api/v1", "/x", "https://a.b/api/v1/x"), ("https://a.b/api/openapi.json", "/x", "https://a.b/api/x"),
    ("https://a.b", "/x", "https://a.b/x"), ("https://a.b/api", "x", "https://a.b/x"),
])
def test_resolve_api_path(spark, base, candidate, expected):
    assert resolved(spark, U.resolve_api_path)[(base, candidate)] == expected


@pytest.mark.parametrize("price,amount,currency", [
    ('{"amount":1234,"currency":"USD"}', 12.34, "USD"), ('{"amount":1234,"currency":"JPY"}', 1234.0, "JPY"), ('{"amount":1234,"currency":"KWD"}', 1.234, "KWD"),
    ('{"amount":"1,234.50","currency":"USD"}', 1234.5, "USD"), ('"1,234.50"', 1234.5, None), ("5", 5.0, None), ("true", 1.0, None), ('"12d"', None, None),
    ('{"amount":100}', 1.0, None), ("null", None, None), ('" 1e3 "', 1000.0, None), ("[1]", None, None),
])
def test_money(spark, price, amount, currency):
    v = F.from_json(F.lit('{"p":%s}' % price), "p variant")["p"]
    got = spark.range(1).select(D.amount_of(v).alias("a"), D.currency_of(v).alias("c")).first()
    assert (got.a, got.c) == (amount, currency)


def test_strings_of_documents(spark):
    doc = {"a": "x\"y: ", "b": [{"k:": "é\n", "n": 5}], "long": "z" * 20000}
    df = spark.createDataFrame([(json.dumps(doc),)], "t string")
    assert df.select(D.strings_of(F.col("t")).alias("s")).first().s == ['x"y: ', "é\n", "z" * 20000]


def test_homepage(spark):
    html = """<TITLE a=1> Two
      words </TITLE><link rel="apple-touch-icon" href=/t.png><link href='i.ico' REL='SHORTCUT icon'><link rel=icon href=https://cdn.example/i>
      <meta name=twitter:image content=/tw.png><meta property="og:image" content="//img.example/a?x=1&amp;y=2"><link rel="service-desc" href="mailto:x">"""
    ok, detail, facts = run(spark, texts.homepage_facts, content_type=None, requested_url="https://a.example/d/", body=html)
    assert ok and detail == "Fetched homepage HTML" and facts["title"] == "Two words"
    assert facts["favicon_url"] == "https://a.example/d/i.ico" and facts["og_image_url"] == "https://img.example/a?x=1&y=2"
    assert facts["service_desc_urls"] is None and facts["shopify_hint"] is False
    assert run(spark, texts.homepage_facts, content_type="image/png", body="x")[0] is False


def test_text_documents(spark):
    assert run(spark, texts.robots_facts, probe_key="robots_txt", body="\n USER-AGENT: *\r\nx\n\n")[2] == {"line_count": 2}
    assert run(spark, texts.robots_facts, probe_key="robots_txt", body="nope")[0] is False
    assert run(spark, texts.sitemap_facts, probe_key="sitemap_xml", content_type="application/rss+xml", body="<RSS/>")[2] == {"sitemap_kind": "rss"}
    assert run(spark, texts.sitemap_facts, probe_key="sitemap_xml", content_type="text/plain", body="x")[0] is False
    text = "x402\nGateway https://g.example/v1, https://g.example/v2.\nhttps://p.example/.well-known/x402"
    ok, _, facts = run(spark, texts.llms_facts, probe_key="llms_txt", content_type="text/plain", body=text)
    assert ok and facts["x402_urls"] == ["https://p.example/.well-known/x402", "https://g.example/.well-known/x402.json"]
    key = {"probe_key": "llms_txt", "content_type": "text/plain"}
    login, markup = run_all(spark, texts.llms_facts, {**key, "body": "signin login"}, {**key, "body": "<foo/>"})
    assert "login" in login[1] and "markup" in markup[1]


def hint(spark, *strings):
    df = spark.createDataFrame([(list(strings),)], "s array<string>")
    h = df.select(hints.payment_hints(F.col("s")).alias("h")).first().h
    return h.payment_provider_hints, h.payment_rail_hints, h.payment_surface, h.crypto_only


def test_payment_hints(spark):
    assert hint(spark, "discard me") == ([], [], None, False)
    assert hint(spark, "https://pay.google.com/x") == (["google_pay"], [], "provider_named", False)
    assert hint(spark, "USDC", "card")[1:] == (["card", "crypto"], "standard_checkout", False)
    assert hint(spark, "USDC only")[1:] == (["crypto"], "crypto", True)
    assert hint(spark, "x402 with a wallet")[1:] == (["x402"], "x402", True)
    assert hint(spark, "x402")[1:] == (["x402"], "x402", False)
    assert hint(spark, "https://visa.example/card") == ([], [], None, False)


def test_agent_endpoints_at_any_depth(spark):
    def nested(levels, inner):
        for i in reversed(range(levels)):
            inner = {f"k{i}": inner}
        return inner

    key, base = {"probe_key": "well_known_agent_json"}, "https://a.example"
    deep = {**nested(40, {"products": "/deep", "register": {"url": "/r", "auth": True}, "n": 5, "list": ["/no"], "empty": {}}), "orders": "/orders"}
    between = {"a": {"docs": "/first", "x": nested(9, {"docs": {"path": "/second"}}), "z": {"docs": {"href": " /third "}}}, "docs": {"path": "/fourth", "products": "/hidden"}}
    rows = [{**key, "body": {"name": "n", "endpoints": e}} for e in (deep, between, {}, {"products": "/flat"}, "none")]
    far, order, none, flat, text = [facts for _, _, facts in run_all(spark, contracts.agent_facts, *rows)]
    assert far["product_urls"] == [base + "/deep"] and far["register_urls"] == [base + "/r"]
    assert far["public_endpoint_urls"] == [base + "/deep", base + "/orders"]
    assert order["docs_urls"] == [base + p for p in ("/first", "/second", "/third", "/fourth")] and order["product_urls"] == []
    assert none["public_endpoint_urls"] == [] == text["public_endpoint_urls"] and flat["product_urls"] == [base + "/flat"]


def test_cart_and_agents(spark):
    key = {"probe_key": "cart_json"}
    good, typed, cut = run_all(spark, catalog.cart_facts, {**key, "body": {"currency": "EUR", "token": "t"}}, {**key, "body": {"currency": 5}}, {**key, "body": b"{" + b" " * 20_000})
    assert good[2]["has_token"] is True and typed[1] == "cart payload missing currency" and cut[1].startswith("cart response truncated")
    key = {"probe_key": "well_known_agents_json"}
    listed, other, agents, broken = run_all(spark, contracts.agents_facts, {**key, "body": [1, 2]}, {**key, "body": {"x": []}}, {**key, "body": {"agents": [1], "items": [2, 3]}}, {**key, "body": "{"})
    assert listed[2]["entry_count"] == 2 and other[0] is False and agents[2]["entry_count"] == 3 and broken[0] is False


def test_products_forms(spark):
    products = [
        {"title": "A", "handle": "a", "price": 0, "jsonLd": {"offers": {"price": "7.5", "priceCurrency": "usd", "availability": "https://schema.org/PreOrder"}}},
        "skip",
        {"name": "B", "variations": [{"price": None, "checkout_url": "/c?x", "available": False}, {"price": "3", "checkout_url": "/cart/2", "title": "Default Title"}]},
        {"title": "C", "price_range": {"min": {"amount": 500, "currency": "JPY"}}, "variants": []},
    ]
    key = {"probe_key": "products_json", "requested_url": "https://s.example/products.json"}
    (ok, _, f), empty, bare = run_all(spark, catalog.product_facts, {**key, "body": {"data": {"products": products}}}, {**key, "body": []}, {**key, "body": ["x"]})
    assert ok and (f["product_count"], f["variant_count"], f["priced_variant_count"]) == (3, 2, 3)
    assert (f["min_price"], f["max_price"], f["currency_codes"]) == (3.0, 500.0, ["JPY", "USD"])
    assert f["sample_titles"] == ["A", "B", "C"] and f["preorder_product_count"] == 1 and f["stock_statuses"] == ["PreOrder"]
    assert f["checkout_url_count"] == 2 and f["sample_checkout_urls"] == ["https://s.example/c?x", "https://s.example/cart/2"]
    assert [c["url"] for c in f["payment_probe_candidates"]] == ["https://s.example/cart/2"] and f["payment_probe_candidates"][0]["amount"] == "3"
    assert empty[1] == "products list was empty" and bare[1] == "products list did not contain product objects"


def test_commerce_forms(spark):
    key = {"probe_key": "well_known_commerce"}
    doc = {"payment": {}, "status": "pre_order", "checkout_url": "https://c.example/x", "skyfire": {"status": "live", "about": "bitcoin"}, "billing_provider": {"name": "Acme"}}
    listed, other, text, full = run_all(
        spark, commerce.commerce_facts, {**key, "body": [1, {"price": 2}]}, {**key, "body": {"x": 1}},
        {**key, "content_type": "text/plain", "body": "Our Price list"}, {**key, "body": doc})
    assert listed[2]["matching_item_count"] == 1 and other[1] == "commerce JSON lacked price or purchase-like keys" and text[2]["char_count"] == 14
    f = full[2]
    assert f["prelaunch"] and f["payment_provider_hints"] == ["skyfire"] and f["payment_rail_hints"] == ["crypto"] and f["crypto_only"]
    assert f["payment_endpoint_hosts"] == ["c.example"] and f["payment_surface"] == "crypto"


def test_ucp_placeholder(spark):
    key = {"probe_key": "well_known_ucp"}
    good, template, odd = run_all(
        spark, commerce.ucp_facts, {**key, "body": {"ucp": {"version": 2, "supported_versions": {"2": "https://u.example/2"}}}},
        {**key, "body": {"ucp": {"version": "1"}, "n": "your_shop"}}, {**key, "body": {"ucp": 5}})
    assert good[0] and good[2]["ucp_version"] == "2" and template[0] is False and odd[1] == "UCP payload missing top-level ucp object"


def test_x402_headers_and_text(spark):
    packed = base64.urlsafe_b64encode(json.dumps({"scheme": "x402", "asset": "USDC"}).encode()).decode().rstrip("=")
    key = {"probe_key": "x402_json"}
    header, empty, priced, plain, error, listed, text = run_all(
        spark, contracts.x402_facts, {**key, "body": "", "http_status": 402, "headers": {"Payment-Required": packed}}, {**key, "body": ""},
        {**key, "body": {"price": 1}, "http_status": 402}, {**key, "body": {"price": 1}}, {**key, "body": {"statusCode": 404, "details": ""}},
        {**key, "body": [{"accepts": []}, 3]}, {**key, "content_type": "text/plain", "body": "hello"})
    f = header[2]
    assert header[0] and header[1] == "x402 payment challenge detected from headers"
    assert f["payment_required_header_keys"] == ["asset", "scheme"] and f["payment_surface"] == "x402" and f["crypto_only"]
    assert empty[1] == "x402 document was empty" and priced[0] is True and plain[0] is False and text[0] is False
    assert error[1] == "x402 JSON looked like a generic error response" and listed[2]["matching_item_count"] == 1


def test_openapi_invalid(spark):
    key = {"probe_key": "openapi_json"}
    bad, good = run_all(spark, contracts.openapi_facts, {**key, "body": {"paths": {}}}, {**key, "body": {"swagger": "2.0", "paths": {}, "securityDefinitions": {"b": {}, "a": {}}}})
    assert bad[0] is False and good[0] and good[2]["path_count"] == 0 and good[2]["auth_schemes"] == ["a", "b"]


def test_observed_walk(spark):
    deep = {"payment": {"payment_methods": "m0"}}
    for _ in range(7):
        deep = {"d": deep}
    many = {f"k{i}": 1 for i in range(45)}
    many["payment_methods"] = "late"
    docs = [json.dumps(deep), json.dumps(many), json.dumps({"payment": {"assets": ["usdc"] * 25, "networks": [{"id": "n1"}, "n2"], "handlers": {"h": {"protocol": "x"}}}})]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, text string")
    got = {}
    for r in observed.observed_rows(df, ["id"]).orderBy("id", "fact_key", "pos").collect():
        got.setdefault((r.id, r.fact_key), []).append(r.value)
    assert got == {
        (2, "observed_payment_assets"): ["USDC"], (2, "observed_payment_networks"): ["n1", "n2"],
        (2, "observed_payment_handler_names"): ["h"], (2, "observed_payment_protocols"): ["X"],
    }


def test_observed_patterns_are_tried_once(spark):
    rules = len(observed.RULES) + len(observed.ROLES)
    assert str(observed.observed_values(F.col("n"))).lower().count("rlike") == rules
    text = '{"capabilities":[{"id":"i","name":"n"},{"id":"k"}],"payment":{"x":{"supported_assets":["usd"]}},"endpoints":{"quote":{"path":"/p","href":"/h"}},"data":{"payment_handlers":{"h":{"name":"W"},"k":1}}}'
    rows = observed.observed_rows(spark.createDataFrame([(1, text)], "id int, text string"), ["id"])
    assert {(r.fact_key, r.value) for r in rows.collect()} == {
        ("observed_capability_names", "n"), ("observed_capability_names", "k"), ("observed_payment_assets", "USD"), ("observed_quote_endpoints", "/h"),
        ("observed_payment_handler_names", "W"), ("observed_payment_handler_names", "k")}


def test_addresses_are_split_once(spark):
    # every component of candidate and base at most once, and the origin of rooted ones
    plan = str(U.resolve(F.col("b"), F.col("c"))).lower()
    assert plan.count("regexp_extract") <= 12 and "isnull(x_" in plan
    base = "https://H.example/a/b.json?q=1"
    wanted = {
        None: None, " ": None, "/x": "https://H.example/x", "x/../y?z#f": "https://H.example/a/y?z#f", "../../u": "https://H.example/u", "?n=2": "https://H.example/a/b.json?n=2",
        "#f": "https://H.example/a/b.json?q=1#f", "//k.example/p": "https://k.example/p", "mailto:m@x": "mailto:m@x", "http://o.example": "http://o.example", "/./v/.w": "https://H.example/v/.w",
    }
    rows = spark.createDataFrame([(i, base, c) for i, c in enumerate(wanted)], "id int, b string, c string")
    got = {r.c: (r.u, r.v) for r in rows.select("c", U.resolve(F.col("b"), F.col("c")).alias("u"), U.resolve_api_path(F.col("b"), F.col("c")).alias("v")).collect()}
    assert {c: u for c, (u, _) in got.items()} == wanted
    assert got["/x"][1] == "https://H.example/a/x" and got[None][1] is None and got["x/../y?z#f"][1] == wanted["x/../y?z#f"]
    assert rows.where("c IS NULL OR c = '/x'").select(U.resolve(F.lit(None).cast("string"), F.col("c")).alias("u")).distinct().collect()[0].u is None
