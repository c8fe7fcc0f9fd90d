"""Fact jobs over documents, pages and catalogues built from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driver_queries.base import VARIANT_LOG, query, run_sql, spread_out, table
from signpost.functions import documents as D
from signpost.functions import text as T
from signpost.functions import urls as U
from signpost.operators.facts import catalog, hints, texts


def as_fetches(df: DataFrame, body: Column, probe_key: str, url: Column, content_type: Column, status: int = 200) -> DataFrame:
    """Any table as captured responses of one probe."""
    return df.withColumns(
        {
            "probe_key": F.lit(probe_key), "requested_url": url, "final_url": url, "http_status": F.lit(status),
            "content_type": content_type, "body": F.encode(body, "UTF-8"), "truncated": F.lit(False),
            "request_method": F.lit("GET"),
        }
    ).withColumn("byte_count", F.octet_length("body").cast("bigint"))


# ---------------------------------------------------------------- pages and texts

PAGE_HTML = """
SELECT page_id, url, concat(html,
  '<LINK rel="shortcut ICON" href="/fav', CAST(page_id AS STRING), '.ico">',
  CASE WHEN page_id % 3 = 0 THEN concat('<link href=''../api/', CAST(page_id AS STRING), '.json'' rel=service-desc>') ELSE '' END,
  CASE WHEN page_id % 2 = 0 THEN concat('<meta name="twitter:image" content="https://img.example/t.png"><meta content="img/', CAST(page_id AS STRING), '.png?a=1&amp;b=2&eacute;&#8211;&#x2F;&frac14x&CounterClockwiseContourIntegral;" property="og:image">') ELSE '' END,
  CASE WHEN page_id % 5 = 0 THEN 'cdn.Shopify.com' ELSE '' END) AS html
FROM pages
"""
ORIGIN_SQL = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
DIR_SQL = f"concat({ORIGIN_SQL}, regexp_replace(CASE WHEN regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) END, '[^/]*$', ''))"
PARENT_SQL = f"regexp_replace({DIR_SQL}, '^(https?://[^/]+/)(.*/)?[^/]+/$', '\\1\\2')"


@query(
    "homepage_facts",
    f"""SELECT page_id, true AS is_valid, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')), '') AS title,
        contains(lower(html), 'shopify') OR page_id % 5 = 0 AS shopify_hint,
        concat({ORIGIN_SQL}, '/fav', page_id, '.ico') AS favicon_url,
        CASE WHEN page_id % 2 = 0 THEN concat({DIR_SQL}, 'img/', page_id, '.png?a=1&b=2', chr(233), chr(8211), '/', chr(188), 'x', chr(8755)) END AS og_image_url,
        CASE WHEN page_id % 3 = 0 THEN concat({PARENT_SQL}, 'api/', page_id, '.json') END AS service_desc
        FROM pages""",
)
def homepage_facts(spark, sf):
    pages = spread_out(run_sql(spark, sf, PAGE_HTML))
    facts = texts.homepage_facts(as_fetches(pages, F.col("html"), "homepage", F.col("url"), F.lit("text/html")).drop("html"))
    return facts.select(
        "page_id", "is_valid", "facts.title", "facts.shopify_hint", "facts.favicon_url", "facts.og_image_url",
        F.get("facts.service_desc_urls", F.lit(0)).alias("service_desc"),
    )


TRIMMED = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
LINES_SQL = r"len(string_split_regex({0}, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{{85}}\x{{2028}}\x{{2029}}]'))"
ROBOTS_TEXT = "CASE WHEN doc_id % 3 = 0 THEN concat('  User-Agent: *', chr(10), text) ELSE text END"


@query(
    "robots_facts",
    f"""SELECT doc_id, contains(lower(t), 'user-agent') AS is_valid, CASE WHEN contains(lower(t), 'user-agent') THEN {LINES_SQL.format('t')} END AS line_count
        FROM (SELECT doc_id, {TRIMMED.format(ROBOTS_TEXT)} AS t FROM documents) d""",
)
def robots_facts(spark, sf):
    docs = run_sql(spark, sf, f"SELECT doc_id, {ROBOTS_TEXT} AS text FROM documents").withColumnRenamed("text", "t")
    facts = texts.robots_facts(as_fetches(docs, F.col("t"), "robots_txt", F.lit("https://a.example/robots.txt"), F.lit("text/plain")).drop("t"))
    return facts.select("doc_id", "is_valid", F.col("facts.line_count").cast("bigint").alias("line_count"))


SITEMAP_TEXT = """
concat(CASE doc_id % 5 WHEN 0 THEN '<?xml version="1.0"?><URLSET>' WHEN 1 THEN '<sitemapindex>' WHEN 2 THEN '<?xml?><rss>' WHEN 3 THEN '<?xml?>' ELSE '' END, text)
"""


@query(
    "sitemap_kind",
    f"""SELECT doc_id, doc_id % 5 <> 4 OR doc_id % 7 = 0 OR contains(lower(text), '<urlset') OR contains(lower(text), '<sitemapindex') OR starts_with(lower(text), '<?xml') AS is_valid,
        CASE WHEN contains(lower(t), '<urlset') THEN 'urlset' WHEN contains(lower(t), '<sitemapindex') THEN 'sitemapindex'
             WHEN doc_id % 5 = 4 AND doc_id % 7 <> 0 THEN NULL WHEN contains(lower(t), '<rss') THEN 'rss' ELSE 'xml' END AS sitemap_kind
        FROM (SELECT doc_id, text, {SITEMAP_TEXT} AS t FROM documents) d""",
)
def sitemap_kind(spark, sf):
    docs = run_sql(spark, sf, f"SELECT doc_id, {SITEMAP_TEXT} AS t FROM documents")
    kind = F.when(F.col("doc_id") % 7 == 0, "application/atom+XML; q=1").otherwise("text/plain")
    facts = texts.sitemap_facts(as_fetches(docs, F.col("t"), "sitemap_xml", F.lit("https://a.example/sitemap.xml"), kind).drop("t"))
    return facts.select("doc_id", "is_valid", "facts.sitemap_kind")


LLMS_TEXT = """
concat(text, chr(10),
  CASE WHEN doc_id % 3 = 0 THEN concat('REST API base: https://api', CAST(doc_id AS STRING), '.example/v1), x402 ready', chr(10)) ELSE '' END,
  CASE WHEN doc_id % 4 = 0 THEN concat('see (https://pay', CAST(doc_id AS STRING), '.example/.well-known/x402).', chr(10)) ELSE '' END,
  CASE WHEN doc_id % 9 = 0 THEN 'sign in: SignIn and login here' ELSE '' END)
"""
HTMLISH = "regexp_matches(lower({0}), '<!doctype html|<html|<head|<body|<title|<meta |<script|<iframe|<frame|<style|<center|<table|<tr|<td|<form|<div|<span|<p|<a |<h[1-6]') AND contains({0}, '<') AND contains({0}, '>')"
MARKUP = f"(starts_with({{0}}, '<') AND (({HTMLISH}) OR starts_with({{0}}, '<?xml') OR regexp_matches(lower({{0}}), '^(<error|<response|<message|<status|<statuscode|<code|<resource|<urlset|<sitemapindex|<rss|<feed)') OR regexp_matches({{0}}, '^<[a-zA-Z][a-zA-Z0-9_:-]*(\\s|>|/)')))"
LOGIN = "((contains(lower({0}), 'retpath')::INT + contains(lower({0}), 'is_autologin')::INT + contains(lower({0}), 'passport')::INT + contains(lower({0}), 'signin')::INT + contains(lower({0}), 'login')::INT + contains(lower({0}), 'document.createelement(''form'')')::INT + contains(lower({0}), 'document.createelement(\"form\")')::INT) >= 2)"
ERROR_PAGE = f"(regexp_matches(lower({{0}}), 'web firewall security policies|security policies have been blocked|request / response that are contrary|detect url|common-error|wh_errcode=404') OR (contains(lower({{0}}), 'page not found') AND ({HTMLISH})) OR (contains(lower({{0}}), 'not found') AND contains(lower({{0}}), 'redirecturl=')))"


@query(
    "llms_facts",
    f"""SELECT doc_id, ok AS is_valid, CASE WHEN ok THEN length(t) END AS char_count,
        CASE WHEN ok THEN nullif(concat_ws(',', CASE WHEN doc_id % 4 = 0 THEN concat('https://pay', doc_id, '.example/.well-known/x402') END,
          CASE WHEN doc_id % 3 = 0 THEN concat('https://api', doc_id, '.example/.well-known/x402.json') END), '') END AS x402_urls
        FROM (SELECT doc_id, t, NOT {LOGIN.format('t')} AND NOT {ERROR_PAGE.format('t')} AND NOT {MARKUP.format('t')} AND t <> '' AS ok
              FROM (SELECT doc_id, {TRIMMED.format(LLMS_TEXT)} AS t FROM documents) x) d""",
)
def llms_facts(spark, sf):
    docs = spread_out(run_sql(spark, sf, f"SELECT doc_id, {LLMS_TEXT} AS t FROM documents"))
    facts = texts.llms_facts(as_fetches(docs, F.col("t"), "llms_txt", F.lit("https://a.example/llms.txt"), F.lit("text/plain")).drop("t"))
    return facts.select("doc_id", "is_valid", F.col("facts.char_count").cast("bigint").alias("char_count"), F.array_join("facts.x402_urls", ",").alias("x402_urls"))


@query(
    "body_shape",
    f"""SELECT 'd' || doc_id AS id, {LOGIN.format('text')} AS login, {HTMLISH.format('text')} AS html, {MARKUP.format("regexp_replace(text, '^\\s+', '')")} AS markup, {ERROR_PAGE.format('text')} AS error_page, false AS checkout_url FROM documents
        UNION ALL SELECT 'p' || page_id, {LOGIN.format('html')}, {HTMLISH.format('html')}, {MARKUP.format("regexp_replace(html, '^\\s+', '')")}, {ERROR_PAGE.format('html')}, page_id % 2 = 0 OR regexp_matches(lower(url), 'shop.app/checkout/|/checkouts/|/checkout|/cart/') FROM pages""",
)
def body_shape(spark, sf):
    docs = table(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text", F.lit(None).cast("string").alias("url"))
    url = F.when(F.col("page_id") % 2 == 0, F.concat("url", F.lit("?skip_shop_pay=1"))).otherwise(F.col("url"))
    pages = table(spark, sf, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), F.col("html").alias("text"), url.alias("url"))
    rows = docs.unionByName(pages)
    t = F.col("text")
    return rows.select(
        "id", T.is_login_handoff(t).alias("login"), T.is_html_fragment(t).alias("html"), T.is_markup_fragment(t).alias("markup"),
        T.is_error_page(t).alias("error_page"), U.is_checkout_url(F.col("url")).alias("checkout_url"),
    )


STATUS_WORDS = """
SELECT event_id, CASE event_id % 9 WHEN 0 THEN concat('  LIVE', chr(9)) WHEN 1 THEN 'available' WHEN 2 THEN 'Pre_Order' WHEN 3 THEN 'planned '
  WHEN 4 THEN 'Human_Browser_Checkout' WHEN 5 THEN '' WHEN 6 THEN event_type WHEN 7 THEN concat('Your_', event_type) END AS word FROM events
"""


@query(
    "status_predicates",
    """SELECT event_id, coalesce(event_id % 9 IN (0, 1), false) AS live, event_id % 9 IN (0, 1, 5, 8) AS active_offer,
              event_id % 9 IN (2, 3) AS prelaunch, event_id % 9 = 4 AS human_checkout, event_id % 9 = 7 AS placeholder FROM events""",
)
def status_predicates(spark, sf):
    w = F.col("word")
    return run_sql(spark, sf, STATUS_WORDS).select(
        "event_id", T.is_live(w).alias("live"), T.is_active_offer(w).alias("active_offer"), T.is_prelaunch(w).alias("prelaunch"),
        T.is_human_checkout(w).alias("human_checkout"), T.is_placeholder(w).alias("placeholder"),
    )


# a vocabulary that occurs in the documents
VOCABULARY = {"providers": {"alpha": ["the", "of"], "beta": ["que"], "gamma": ["@"]}, "rails": {"card": ["nicht"], "crypto": ["and", "of the"]}}


def _word(marker, text="low"):
    return f"regexp_matches({text}, '(^|[^a-z0-9]){marker}([^a-z0-9]|$)')"


@query(
    "payment_hints",
    f"""SELECT doc_id, concat_ws(',', CASE WHEN a THEN 'alpha' END, CASE WHEN b THEN 'beta' END, CASE WHEN g THEN 'gamma' END) AS providers,
        concat_ws(',', CASE WHEN c THEN 'card' END, CASE WHEN y THEN 'crypto' END) AS rails,
        CASE WHEN c THEN 'standard_checkout' WHEN y THEN 'crypto' WHEN a OR b OR g THEN 'provider_named' END AS payment_surface, y AND NOT c AS crypto_only
        FROM (SELECT doc_id, {_word('the')} OR {_word('of')} AS a, {_word('que')} AS b, {_word('@')} AS g, {_word('nicht')} AS c, {_word('and')} OR contains(low, 'of the') AS y
              FROM (SELECT doc_id, lower(list_aggregate(list_filter(list_transform(string_split(text, chr(10)), lambda s: {TRIMMED.format('s')}), lambda s: NOT starts_with(s, 'http://') AND NOT starts_with(s, 'https://') AND s <> ''), 'string_agg', chr(10))) AS low FROM documents) l) m""",
)
def payment_hints(spark, sf):
    found = hints.text_hints(spread_out(table(spark, sf, "documents").select("doc_id", "text")), "text", **VOCABULARY)
    return found.select(
        "doc_id", F.array_join("hints.payment_provider_hints", ",").alias("providers"), F.array_join("hints.payment_rail_hints", ",").alias("rails"),
        "hints.payment_surface", "hints.crypto_only",
    )


# ---------------------------------------------------------------- catalogues from line items

SCALE = "CASE currency WHEN 'JPY' THEN 1.0 WHEN 'USD' THEN 100.0 ELSE 1000.0 END"


def catalog_documents(spark, sf) -> DataFrame:
    """One catalogue body per order: a product per currency, a variant per line item."""
    variant = F.struct(
        F.struct(F.col("minor_amount").alias("amount"), "currency").alias("price"), "available",
        F.when(F.col("available"), F.concat(F.lit("/checkouts/"), F.col("product_id").cast("string"))).alias("checkout_url"),
        F.concat(F.lit("v"), F.col("variant_pos").cast("string")).alias("title"),
        F.when(F.col("variant_pos") == 1, "OnBackOrder").alias("stock_status"),
    )
    products = run_sql(spark, sf, VARIANT_LOG).groupBy("doc_id", "currency").agg(
        F.array_sort(F.collect_list(F.struct("variant_pos", "minor_amount", "product_id", variant.alias("v")))).alias("vs")
    )
    product = F.struct(
        F.concat(F.lit(" Item "), "currency").alias("title"), F.lower("currency").alias("handle"), F.transform("vs", lambda x: x["v"]).alias("variants")
    )
    docs = products.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("currency", product.alias("p")))).alias("ps"))
    body = F.to_json(F.struct(F.transform("ps", lambda x: x["p"]).alias("products")))
    return docs.select("doc_id", F.concat(F.lit("shop"), F.col("doc_id").cast("string"), F.lit(".example")).alias("domain"), body.alias("json"))


def catalog_fetches(spark, sf) -> DataFrame:
    docs = catalog_documents(spark, sf)
    url = F.concat(F.lit("https://"), F.col("domain"), F.lit("/products.json"))
    return as_fetches(docs, F.col("json"), "products_json", url, F.lit("application/json")).drop("json")


CATALOG_SQL = f"""
SELECT doc_id, count(DISTINCT currency) AS product_count, count(*) AS variant_count, count(*) AS priced_variant_count,
       string_agg(DISTINCT currency, ',' ORDER BY currency) AS currency_codes, min(minor_amount / {SCALE}) AS min_price, max(minor_amount / {SCALE}) AS max_price,
       string_agg(DISTINCT concat('Item ', currency), ',' ORDER BY concat('Item ', currency)) AS sample_titles,
       nullif(count(*) FILTER (WHERE available), 0) AS checkout_url_count,
       arg_min(concat('https://shop', doc_id, '.example/checkouts/', product_id), (currency, variant_pos, minor_amount, product_id)) FILTER (WHERE available) AS first_checkout,
       CASE WHEN bool_or(variant_pos = 1) THEN 'OnBackOrder' ELSE '' END AS stock_statuses
FROM ({VARIANT_LOG}) v GROUP BY doc_id
"""


@query("product_facts", CATALOG_SQL)
def product_facts(spark, sf):
    facts = catalog.product_facts(catalog_fetches(spark, sf)).where("is_valid")
    big = lambda n: F.col(f"facts.{n}").cast("bigint").alias(n)
    return facts.select(
        "doc_id", big("product_count"), big("variant_count"), big("priced_variant_count"), F.array_join("facts.currency_codes", ",").alias("currency_codes"),
        "facts.min_price", "facts.max_price", F.array_join("facts.sample_titles", ",").alias("sample_titles"), big("checkout_url_count"),
        F.get("facts.sample_checkout_urls", F.lit(0)).alias("first_checkout"), F.array_join("facts.stock_statuses", ",").alias("stock_statuses"),
    )


PRICE_JSON = """
SELECT l_orderkey, l_linenumber,
  CASE l_linenumber % 7
    WHEN 0 THEN concat('{"amount":', CAST(CAST(l_extendedprice AS BIGINT) AS STRING), ',"currency":" jpy "}')
    WHEN 1 THEN concat('{"amount":', CAST(CAST(l_extendedprice AS BIGINT) AS STRING), ',"currency":"KWD"}')
    WHEN 2 THEN concat('{"amount":', CAST(CAST(l_extendedprice AS BIGINT) AS STRING), '}')
    WHEN 3 THEN concat('{"amount":"1,', CAST(CAST(l_extendedprice AS BIGINT) AS STRING), '.50","currency":"USD"}')
    WHEN 4 THEN concat('"  ', CAST(CAST(l_extendedprice AS BIGINT) AS STRING), 'e0 "')
    WHEN 5 THEN CAST(CAST(l_extendedprice AS BIGINT) AS STRING)
    ELSE '"12d"' END AS price
FROM lineitem
"""


@query(
    "price_normalize",
    """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 7 WHEN 0 THEN b WHEN 1 THEN b / 1000.0 WHEN 2 THEN b / 100.0
         WHEN 3 THEN CAST(concat('1', b, '.50') AS DOUBLE) WHEN 4 THEN b WHEN 5 THEN b END::DOUBLE AS price,
         CASE l_linenumber % 7 WHEN 0 THEN ' jpy ' WHEN 1 THEN 'KWD' WHEN 3 THEN 'USD' END AS currency
       FROM (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS BIGINT) AS b FROM lineitem) l""",
)
def price_normalize(spark, sf):
    rows = spread_out(run_sql(spark, sf, PRICE_JSON.replace("CAST(CAST(l_extendedprice AS BIGINT) AS STRING)", "CAST(CAST(rint(l_extendedprice) AS BIGINT) AS STRING)")))
    v = F.from_json(F.concat(F.lit('{"p":'), "price", F.lit("}")), "p variant")["p"]
    return rows.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), D.amount_of(v).alias("price"), D.currency_of(v).alias("currency"))


@query("cart_facts", """SELECT o_orderkey, o_orderkey % 5 <> 0 AS is_valid, CASE WHEN o_orderkey % 5 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE 'EUR' END END AS currency,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS item_count, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0 THEN true END AS has_token FROM orders""")
def cart_facts(spark, sf):
    rows = run_sql(spark, sf, """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 5 END AS bad, concat('{"token":', CASE WHEN o_orderkey % 3 = 0 THEN '"t"' ELSE 'null' END,
        ',"currency":', CASE WHEN o_orderkey % 5 = 0 THEN '5' WHEN o_orderkey % 2 = 0 THEN '"USD"' ELSE '"EUR"' END, ',"item_count":', CAST(o_custkey AS STRING), '}') AS json FROM orders""")
    facts = catalog.cart_facts(as_fetches(rows, F.col("json"), "cart_json", F.lit("https://a.example/cart.js"), F.lit("application/json")).drop("json", "bad"))
    return facts.select("o_orderkey", "is_valid", "facts.currency", D.as_whole(F.col("facts.item_count")).alias("item_count"), "facts.has_token")


def tool_answers(spark, sf) -> DataFrame:
    """Each catalogue as a tool answer: structured for even orders, as a text item for odd ones."""
    docs = catalog_documents(spark, sf)
    text = F.to_json(F.struct(F.lit("text").alias("type"), F.col("json").alias("text")))
    structured = F.concat(F.lit('{"result":{"structuredContent":'), "json", F.lit("}}"))
    textual = F.concat(F.lit('{"result":{"content":[{"type":"image"},{"text":"none"},'), text, F.lit("]}}"))
    return docs.select(
        "doc_id", "domain", F.when(F.col("doc_id") % 2 == 0, structured).otherwise(textual).alias("text"),
        F.concat(F.lit("https://mcp"), F.col("doc_id").cast("string"), F.lit(".example/rpc")).alias("endpoint"),
        F.lit(200).alias("http_status"), F.lit(False).alias("truncated"),
    )


@query(
    "ucp_products",
    f"SELECT doc_id, product_count, variant_count, max_price, replace(first_checkout, 'https://shop', 'https://mcp') AS first_checkout, CASE WHEN first_checkout IS NOT NULL THEN 'ucp_catalog_checkout' END AS source FROM ({CATALOG_SQL}) c",
)
def ucp_products(spark, sf):
    facts = catalog.tool_product_facts(tool_answers(spark, sf))
    return facts.select(
        "doc_id", F.col("facts.product_count").cast("bigint").alias("product_count"), F.col("facts.variant_count").cast("bigint").alias("variant_count"),
        "facts.max_price", F.get("facts.sample_checkout_urls", F.lit(0)).alias("first_checkout"), F.get("facts.payment_probe_candidates", F.lit(0))["source"].alias("source"),
    )


# ---------------------------------------------------------------- contracts built from orders and line items

from signpost.operators.facts import commerce, contracts, observed  # noqa: E402

ORDER_DOCS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(round(o_totalprice) AS BIGINT) AS price FROM orders
"""


def json_fetches(spark, sf, sql, probe_key, path, headers=None, status=200):
    """(id columns, json) rows as captured JSON responses of https://h<o_custkey>.example."""
    rows = spread_out(run_sql(spark, sf, sql))
    url = F.concat(F.lit("https://h"), F.col("o_custkey").cast("string"), F.lit(f".example{path}"))
    fetched = as_fetches(rows, F.col("json"), probe_key, url, F.lit("application/json"), status)
    none = F.create_map().cast("map<string,string>")
    return fetched.drop("json").withColumn("headers", none if headers is None else headers).withColumn("error", F.lit(None).cast("string"))


COMMERCE_JSON = """
SELECT o_orderkey, o_custkey, concat('{"status":"', CASE WHEN o_orderkey % 11 = 0 THEN 'Coming_Soon' ELSE 'live' END, '","',
  CASE WHEN o_orderkey % 2 = 0 THEN 'offers' ELSE 'offerings' END, '":[',
  '{"id":"a","title":"Plan ', CAST(o_orderkey % 5 AS STRING), '","price":{"amount":', CAST(CAST(round(o_totalprice) AS BIGINT) AS STRING), ',"currency":"usd"},"api":{"purchase_intent":"https://pay', CAST(o_custkey AS STRING), '.example/i"}},',
  '{"id":"a","title":"Plan ', CAST(o_orderkey % 5 AS STRING), '","status":"planned","price":"9"},', '"skip",',
  '{"offer":"b","name":"Extra","status":" Enabled","price":"5","priceCurrency":"eur","api":{"purchase_intent":" https://pay', CAST(o_custkey AS STRING), '.example/i "}}],',
  '"checkout_url":"https://shop', CAST(o_custkey AS STRING), '.example/checkout","auth":{"purchase_intent":" Bearer "},',
  '"paymentHandlers":["card","',  CASE WHEN o_orderkey % 3 = 0 THEN 'crypto' ELSE 'card' END, '"],',
  '"machine_payment_paths":[{"id":"p1","kind":"x","status":"', CASE WHEN o_orderkey % 4 = 0 THEN 'active' ELSE 'off' END, '","note":"pay with USDC or Stripe"},{"id":"p2","kind":"human_browser_checkout","status":"live","note":"visa"}]}') AS json
FROM orders
"""


@query(
    "commerce_facts",
    """SELECT o_orderkey, true AS is_valid, 3 AS offer_count, CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 2 END AS active_offer_count, 2 AS priced_offer_count,
        concat('Plan ', o_orderkey % 5, ',Extra') AS sample_titles, concat('https://pay', o_custkey, '.example/i') AS intents, 'bearer' AS auth,
        CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS live_paths, CASE WHEN o_orderkey % 4 = 0 THEN 'stripe' ELSE '' END AS providers,
        CASE WHEN o_orderkey % 4 = 0 THEN 'crypto' WHEN o_orderkey % 3 = 0 THEN 'card,crypto' ELSE 'card' END AS rails,
        CASE WHEN o_orderkey % 4 = 0 THEN 'crypto' ELSE 'standard_checkout' END AS surface, o_orderkey % 4 = 0 AS crypto_only, o_orderkey % 11 = 0 AS prelaunch FROM orders""",
)
def commerce_facts(spark, sf):
    facts = commerce.commerce_facts(json_fetches(spark, sf, COMMERCE_JSON, "well_known_commerce", "/.well-known/commerce"))
    big = lambda n, a=None: F.col(f"facts.{n}").cast("bigint").alias(a or n)
    join = lambda n, a: F.array_join(f"facts.{n}", ",").alias(a)
    return facts.select(
        "o_orderkey", "is_valid", big("offer_count"), big("active_offer_count"), big("priced_offer_count"), F.array_join("facts.sample_offers.title", ",").alias("sample_titles"),
        join("purchase_intent_urls", "intents"), F.col("facts.purchase_intent_auth").alias("auth"), big("live_machine_payment_path_count", "live_paths"),
        join("payment_provider_hints", "providers"), join("payment_rail_hints", "rails"), F.col("facts.payment_surface").alias("surface"), "facts.crypto_only", "facts.prelaunch",
    )


UCP_JSON = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN '{"ucp":{}}' WHEN o_orderkey % 7 = 1 THEN '{"ucp":{"version":"1","x":"https://merchant.com/a"}}' ELSE
  concat('{"ucp":{"version":"v', CAST(o_orderkey % 3 AS STRING), '","supported_versions":{"v1":"https://ucp.example/', CAST(o_orderkey AS STRING), '"},"capabilities":',
  CASE WHEN o_orderkey % 2 = 0 THEN '{"b.cap":{},"a.cap":[]}' ELSE '[{"name":"z.cap"},{"id":1},{"name":"y.cap"}]' END,
  ',"services":{"dev.ucp.shopping":[{"transport":"mcp","endpoint":"https://mcp', CAST(o_custkey AS STRING), '.example/rpc"},{"transport":"rest","endpoint":"/r"}],"other":{}},',
  '"payment_handlers":{"gpay":[{"id":"g1","url":"https://pay.google.com/x"}],"card":{"id":"c1"}}},"payment":{"handlers":[{"id":"h1","name":"Wallet","doc":"https://h.example/doc"}]}}') END AS json
FROM orders
"""


@query(
    "ucp_facts",
    """SELECT o_orderkey, o_orderkey % 7 > 1 AS is_valid, CASE WHEN ok THEN concat('v', o_orderkey % 3) END AS version, CASE WHEN ok THEN 2 END AS capability_count,
        CASE WHEN NOT ok THEN NULL WHEN o_orderkey % 2 = 0 THEN 'a.cap,b.cap' ELSE 'z.cap,y.cap' END AS capability_names, CASE WHEN ok THEN 2 END AS service_count,
        CASE WHEN ok THEN 'Wallet,card,gpay' END AS handler_names, CASE WHEN ok THEN 'c1,g1,h1' END AS handler_ids, CASE WHEN ok THEN 'https://h.example/doc,https://pay.google.com/x' END AS endpoints,
        CASE WHEN ok THEN concat('https://mcp', o_custkey, '.example/rpc') END AS mcp, CASE WHEN ok AND o_orderkey % 3 = 1 THEN concat('https://ucp.example/', o_orderkey) END AS current_version_url,
        CASE WHEN ok THEN 'google_pay' END AS providers
        FROM (SELECT *, o_orderkey % 7 > 1 AS ok FROM orders) o""",
)
def ucp_facts(spark, sf):
    facts = commerce.ucp_facts(json_fetches(spark, sf, UCP_JSON, "well_known_ucp", "/.well-known/ucp"))
    join = lambda n, a: F.array_join(f"facts.{n}", ",").alias(a)
    return facts.select(
        "o_orderkey", "is_valid", F.col("facts.ucp_version").alias("version"), F.col("facts.capability_count").cast("bigint").alias("capability_count"), join("capability_names", "capability_names"),
        F.col("facts.service_count").cast("bigint").alias("service_count"), join("payment_handler_names", "handler_names"), join("payment_handler_ids", "handler_ids"),
        join("payment_endpoint_samples", "endpoints"), join("shopping_mcp_endpoints", "mcp"), "facts.current_version_url", join("payment_provider_hints", "providers"),
    )


AGENT_JSON = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 9 = 0 THEN '{"x":1}' ELSE concat('{"name":"n","url":"/svc","api":{"base_url":"/api/v1","docs":"docs.html"},"discovery":{"openapi":"../spec.json"},',
  '"endpoints":{"shop":{"products":{"path":"/items"},"orders":"/orders"},"register":{"url":"https://x.example/r","auth":true}},',
  '"payment":{"protocol":"X402","networks":[{"name":" base ","chain_id":"8453","currency":"usdc","asset":"0x1"}]},',
  '"x402":{"network":"solana","asset":"usdt","endpoints":{"POST /buy":{"price":"', CAST(o_custkey AS STRING), '","currency":"usd","description":"d"},"/free":{}}},',
  '"capabilities":{"extensions":[{"params":{"currency":"eur","pricing":{"endpoints":{"/batch/{id}":5,"/one":{"price":"2","description":"One"}}}}}]},',
  '"skills":[{"name":"s1","pricing":{"amount":1,"currency":"gbp"}},{"id":"s2"}]}') END AS json FROM orders
"""


@query(
    "agent_facts",
    """SELECT o_orderkey, ok AS is_valid, CASE WHEN ok THEN concat(h, '/svc') END AS service_url, CASE WHEN ok THEN concat(h, '/.well-known/docs.html') END AS docs_url,
        CASE WHEN ok THEN concat(h, '/spec.json') END AS openapi_url, CASE WHEN ok THEN concat(h, '/.well-known/x402.json') END AS x402_url,
        CASE WHEN ok THEN concat(h, '/api/v1/orders,', h, '/api/v1/items,', h, '/buy,', h, '/free') END AS public_urls,
        CASE WHEN ok THEN concat(h, '/api/v1/items') END AS products, CASE WHEN ok THEN 'https://x.example/r' END AS registers,
        CASE WHEN ok THEN 'base,solana' END AS networks, CASE WHEN ok THEN 'USDC,USDT,USD,EUR,GBP' END AS currencies, CASE WHEN ok THEN 4 END AS priced,
        CASE WHEN ok THEN 'POST /buy,/free,{id},one,s1,s2' END AS action_titles, CASE WHEN ok THEN 4 END AS candidates, CASE WHEN ok THEN 'id' END AS templates
        FROM (SELECT o_orderkey, o_orderkey % 9 <> 0 AS ok, concat('https://h', o_custkey, '.example') AS h FROM orders) o""",
)
def agent_facts(spark, sf):
    facts = contracts.agent_facts(json_fetches(spark, sf, AGENT_JSON, "well_known_agent_json", "/.well-known/agent.json"))
    join = lambda n, a: F.array_join(f"facts.{n}", ",").alias(a)
    cands = F.col("facts.payment_probe_candidates")
    return facts.select(
        "o_orderkey", "is_valid", "facts.service_url", "facts.docs_url", "facts.openapi_url", "facts.x402_url", join("public_endpoint_urls", "public_urls"), join("product_urls", "products"),
        join("register_urls", "registers"), join("payment_network_names", "networks"), join("payment_currency_codes", "currencies"), F.col("facts.priced_action_count").cast("bigint").alias("priced"),
        F.array_join("facts.sample_actions.title", ",").alias("action_titles"), F.size(cands).cast("bigint").alias("candidates"),
        F.array_join(F.flatten(F.filter(cands["template_parameters"], lambda t: t.isNotNull())), ",").alias("templates"),
    )


@query(
    "agents_facts",
    "SELECT o_orderkey, o_orderkey % 5 <> 0 AS is_valid, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN o_custkey % 4 ELSE 3 END AS entry_count FROM orders",
)
def agents_facts(spark, sf):
    sql = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN '{"other":[]}' WHEN o_orderkey % 2 = 0 THEN concat('[', CASE o_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '1' WHEN 2 THEN '1,2' ELSE '{},[],3' END, ']')
             ELSE '{"agents":[1,2],"items":"no","results":[{}]}' END AS json FROM orders"""
    facts = contracts.agents_facts(json_fetches(spark, sf, sql, "well_known_agents_json", "/.well-known/agents.json"))
    return facts.select("o_orderkey", "is_valid", F.col("facts.entry_count").cast("bigint").alias("entry_count"))


OPENAPI_JSON = """
SELECT o_orderkey, o_custkey, concat('{"openapi":"3.1","servers":[{"url":"https://api', CAST(o_custkey AS STRING), '.example/v1"}],"components":{"securitySchemes":{"oauth":{},"key":{}}},"paths":{',
  '"/checkout/{id}":{"parameters":[{"name":"Payment-Signature","in":"Header"}],"post":{"summary":"Buy","responses":{"402":{}}},"get":{"responses":{"200":{}}}},',
  '"/checkout/quote":{"get":{}},', '"/api/products":{"get":{"summary":"List all"}},', '"/billing":{"put":{"operationId":"bill","responses":{"402":{}}}},"/n":5',
  CASE WHEN o_orderkey % 3 = 0 THEN ',"/checkout":{"get":{"summary":"all"}}' ELSE '' END, '}}') AS json FROM orders
"""


@query(
    "openapi_facts",
    """SELECT o_orderkey, true AS is_valid, CASE WHEN o_orderkey % 3 = 0 THEN 6 ELSE 5 END AS path_count, 'key,oauth' AS auth_schemes, CASE WHEN o_orderkey % 3 = 0 THEN 4 ELSE 3 END AS commerce_path_count,
        2 AS paid_count, 'POST /checkout/{id},PUT /billing' AS paid_paths, 2 AS signed_count, 'Buy,bill' AS action_titles,
        concat('https://api', o_custkey, '.example/v1/', CASE WHEN o_orderkey % 3 = 0 THEN 'checkout' ELSE 'api/products' END) AS discovery, concat('https://api', o_custkey, '.example/v1/checkout/quote') AS price_url FROM orders""",
)
def openapi_facts(spark, sf):
    facts = contracts.openapi_facts(json_fetches(spark, sf, OPENAPI_JSON, "openapi_json", "/openapi.json"))
    big = lambda n, a: F.col(f"facts.{n}").cast("bigint").alias(a)
    first = F.get("facts.payment_probe_candidates", F.lit(0))
    return facts.select(
        "o_orderkey", "is_valid", big("path_count", "path_count"), F.array_join("facts.auth_schemes", ",").alias("auth_schemes"), big("commerce_path_count", "commerce_path_count"),
        big("payment_required_operation_count", "paid_count"), F.array_join("facts.payment_required_paths", ",").alias("paid_paths"), big("payment_signature_header_count", "signed_count"),
        F.array_join("facts.sample_actions.title", ",").alias("action_titles"), F.array_join(first["discovery_urls"], ",").alias("discovery"), first["price_lookup_url"].alias("price_url"),
    )


X402_JSON = """
SELECT o_orderkey, o_custkey, CASE o_orderkey % 6 WHEN 0 THEN '{"error":"x","message":"Not Found"}' WHEN 1 THEN '{"foo":1}' WHEN 2 THEN '{"resources":[],"note":"Example only"}'
  ELSE concat('{"x402Version":1,"accepts":[{"network":" base ","asset":"0xA","extra":{"name":"usdc"}},7],"services":[{"url":"GET /s/', CAST(o_custkey AS STRING), '","pricing":{"amount":2,"asset":"usdc"},"name":"Svc"}],',
  '"endpoints":{"/search":{"price":0,"amount":"3","currency":"eur"}},"resource":{"url":"https://r.example/x","description":"First thing. Second."},"resources":["POST /send"],',
  '"extensions":{"bazaar":{"info":{"input":{"method":"put","body":{"a":1},"path":"/crawl"}}}}}') END AS json FROM orders
"""


@query(
    "x402_facts",
    """SELECT o_orderkey, ok AS is_valid, CASE WHEN ok THEN concat(h, '/s/', o_custkey, ',', h, '/search,https://r.example/x,', h, '/send,', h, '/crawl') END AS urls, CASE WHEN ok THEN 2 END AS accept_count,
        CASE WHEN ok THEN 'base' END AS networks, CASE WHEN ok THEN 'USDC' END AS currencies, CASE WHEN ok THEN 2 END AS priced, CASE WHEN ok THEN 'Svc,/search,First thing,send,First thing' END AS titles,
        CASE WHEN ok THEN 'GET,POST,POST,PUT' END AS candidate_methods, CASE WHEN ok THEN 'crypto' END AS surface,
        CASE o_orderkey % 6 WHEN 0 THEN 'x402 JSON looked like a generic error response' WHEN 1 THEN 'x402 JSON lacked structured payment evidence'
             WHEN 2 THEN 'x402 document looked like a probe/example, not a live payment surface' ELSE 'x402-like JSON detected' END AS detail
        FROM (SELECT o_orderkey, o_custkey, o_orderkey % 6 > 2 AS ok, concat('https://h', o_custkey, '.example') AS h FROM orders) o""",
)
def x402_facts(spark, sf):
    facts = contracts.x402_facts(json_fetches(spark, sf, X402_JSON, "x402_json", "/.well-known/x402.json"))
    join = lambda n, a: F.array_join(f"facts.{n}", ",").alias(a)
    big = lambda n, a: F.col(f"facts.{n}").cast("bigint").alias(a)
    return facts.select(
        "o_orderkey", "is_valid", join("resource_urls", "urls"), big("accept_count", "accept_count"), join("accept_networks", "networks"), join("accept_currencies", "currencies"),
        big("priced_action_count", "priced"), F.array_join("facts.sample_actions.title", ",").alias("titles"), F.array_join("facts.payment_probe_candidates.method", ",").alias("candidate_methods"),
        F.col("facts.payment_surface").alias("surface"), "detail",
    )


PROBE_CODES = [200, 402, 302, 401, 422, 503, 307, 500, 200]


@query(
    "payment_probe_result",
    """SELECT o_orderkey, o_orderkey % 9 NOT IN (2, 7) AND NOT (o_orderkey % 9 = 8 AND o_orderkey % 2 = 0) AS is_valid,
        CASE o_orderkey % 9 WHEN 0 THEN 'success_without_payment' WHEN 1 THEN 'payment_challenge' WHEN 2 THEN 'redirect_boundary' WHEN 3 THEN 'auth_or_method_boundary' WHEN 4 THEN 'input_validation'
          WHEN 5 THEN 'temporary_failure' WHEN 6 THEN 'browser_checkout_redirect' WHEN 8 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'html_landing_page' ELSE 'browser_checkout_handoff' END END AS probe_result,
        CASE WHEN o_orderkey % 9 = 1 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'accepts,x402Version' ELSE 'a' END END AS response_keys,
        CASE WHEN o_orderkey % 9 = 1 AND o_orderkey % 2 = 0 THEN 1 END AS accept_count, CASE WHEN o_orderkey % 5 = 0 THEN 'accepts,scheme' END AS header_keys,
        CASE WHEN o_orderkey % 5 = 0 THEN 'circle' ELSE '' END AS providers FROM orders""",
)
def payment_probe_result(spark, sf):
    codes = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(PROBE_CODES))
    sql = f"""SELECT o_orderkey, o_custkey, CASE o_orderkey % 9 {codes} END AS code, CASE WHEN o_orderkey % 9 = 8 THEN '<html><body>x</body></html>'
              WHEN o_orderkey % 9 = 1 AND o_orderkey % 2 = 0 THEN '{{"x402Version":1,"accepts":[{{}}]}}' WHEN o_orderkey % 9 = 1 THEN '{{"a":1}}' ELSE 'ok' END AS json FROM orders"""
    encoded = F.base64(F.encode(F.lit('{"scheme":"Circle Gateway","accepts":[]}'), "UTF-8"))
    headers = F.when(F.col("o_orderkey") % 5 == 0, F.create_map(F.lit("x-payment-required"), F.translate(F.rtrim(encoded, F.lit("=")), "+/", "-_")))
    headers = headers.when(F.col("o_orderkey") % 9 == 6, F.create_map(F.lit("location"), F.lit("/checkouts/1"))).otherwise(F.create_map().cast("map<string,string>"))
    rows = json_fetches(spark, sf, sql, "payment_probe", "/buy", headers)
    checkout = F.when((F.col("o_orderkey") % 2 == 1) & (F.col("o_orderkey") % 9 == 8), F.lit("https://s.example/checkout")).when(
        (F.col("o_orderkey") % 9 == 6), F.lit("https://s.example/cart/1")).otherwise(F.col("final_url"))
    kind = F.when(F.substring(F.decode("body", "UTF-8"), 1, 1) == "{", "application/json").otherwise("text/plain")
    fetched = rows.withColumns({"http_status": F.col("code"), "final_url": checkout, "content_type": kind}).drop("code")
    facts = contracts.payment_probe_facts(fetched)
    return facts.select(
        "o_orderkey", "is_valid", "facts.probe_result", F.array_join("facts.response_keys", ",").alias("response_keys"), F.col("facts.accept_count").cast("bigint").alias("accept_count"),
        F.array_join("facts.payment_required_header_keys", ",").alias("header_keys"), F.array_join("facts.payment_provider_hints", ",").alias("providers"),
    )


@query(
    "observed_facts",
    """SELECT o_orderkey, k AS fact_key, v AS value FROM (SELECT o_orderkey, unnest([('observed_capability_names', 'search'), ('observed_capability_names', concat('c', o_custkey)),
        ('observed_payment_protocols', 'MPP'), ('observed_payment_methods', 'card'), ('observed_payment_methods', 'wallet'), ('observed_payment_assets', 'USDC'),
        ('observed_payment_providers', 'acme'), ('observed_payment_providers', 'Pay Co'), ('observed_payment_requirement_keys', 'kyc'), ('observed_payment_flow_types', 'redirect'),
        ('observed_checkout_endpoints', '/co'), ('observed_order_status_endpoints', '/os')]) AS p, p[1] AS k, p[2] AS v FROM orders)""",
)
def observed_facts(spark, sf):
    sql = """SELECT o_orderkey, o_custkey, concat('{"capabilities":["search",{"name":"c', CAST(o_custkey AS STRING), '"},{"id":"search"}],"payment":{"protocol":"mpp","flow":{"type":" redirect "},"requirements":{"kyc":1},',
             '"supported_methods":["card",{"name":"wallet"}],"deep":{"assets":"usdc"},"providers":{"acme":5,"x":{"name":"Pay Co"}}},"assets":["no"],"endpoints":{"Checkout":{"path":"/p","url":"/co"},"order status":"/os"}}') AS json FROM orders"""
    rows = spread_out(run_sql(spark, sf, sql)).withColumnRenamed("json", "text")
    return observed.observed_rows(rows, ["o_orderkey"]).select("o_orderkey", "fact_key", "value")
