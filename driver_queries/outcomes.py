"""Outcome ladder, merges, candidates and classification over logs derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driver_queries.base import FETCH_LOG, STATUS_OF_FETCH, query, run_sql, table
from driver_queries.facts import CATALOG_SQL, catalog_fetches, tool_answers
from signpost import values as V
from signpost.functions import text as T
from signpost.operators import candidates as C
from signpost.operators import classify, merges, outcomes, scoring
from signpost.operators.facts import catalog
from signpost.operators.facts.texts import title_of
from signpost.sources.fetches import limit_bodies

# ---------------------------------------------------------------- captured responses


def fetch_rows(spark, sf) -> DataFrame:
    rows = run_sql(spark, sf, FETCH_LOG).withColumn("body", F.encode("body", "UTF-8"))
    return limit_bodies(rows.withColumns({
        "fetched_at": F.col("ts").cast("timestamp"), "control_group": F.lit(None).cast("string"),
        "headers": F.map_filter(F.create_map(F.lit("retry-after"), F.col("retry_after")), lambda k, v: v.isNotNull()),
    }))


@query(
    "login_gate",
    f"SELECT pos, probe_key <> 'homepage' AND pos % 11 = 0 AS gated FROM ({FETCH_LOG}) f",
)
def login_gate(spark, sf):
    return run_sql(spark, sf, FETCH_LOG).select("pos", outcomes.is_login_gate().alias("gated"))


@query(
    "retry_after",
    f"""SELECT pos, CASE WHEN retry_after = '120' THEN 120 WHEN pos % 5 = 3 THEN pos % 50
             WHEN pos % 5 = 1 THEN greatest(0, CAST(floor(epoch(TIMESTAMP '2024-01-14 12:00:00') - epoch(ts)) AS BIGINT)) END::BIGINT AS retry_after_seconds FROM ({FETCH_LOG}) f""",
)
def retry_after(spark, sf):
    rows = run_sql(spark, sf, FETCH_LOG)
    return rows.select("pos", outcomes.retry_after(F.col("retry_after"), F.col("ts").cast("timestamp")).alias("retry_after_seconds"))


@query(
    "content_type",
    f"""SELECT pos, CASE pos % 4 WHEN 0 THEN 'application/json' WHEN 1 THEN 'text/plain' WHEN 2 THEN 'text/html' END AS media,
               pos % 4 = 0 AS is_json, pos % 4 <> 3 AS is_text, pos % 4 = 2 AS is_html, false AS is_xml FROM ({FETCH_LOG}) f""",
)
def content_type(spark, sf):
    c = F.col("content_type")
    return run_sql(spark, sf, FETCH_LOG).select(
        "pos", T.media_type(c).alias("media"), T.is_json_type(c).alias("is_json"), T.is_text_type(c).alias("is_text"),
        T.is_html_type(c).alias("is_html"), T.is_xml_type(c).alias("is_xml"),
    )


# fixed values of the check: a page's own limit and the smaller one of control responses
PAGE_FETCHES = """
SELECT page_id, concat('p', CAST(page_id AS STRING), '.example') AS domain, 1 AS attempt, 'robots_txt' AS probe_key, 'text' AS control_group,
       200 AS http_status, 'text/html; charset=utf-8' AS content_type, html FROM pages
UNION ALL
SELECT page_id, concat('p', CAST(page_id AS STRING), '.example') AS domain, 1 AS attempt, 'control:text' AS probe_key, 'text' AS control_group,
       CASE WHEN page_id % 7 = 0 THEN 404 ELSE 200 END AS http_status, CASE WHEN page_id % 5 = 0 THEN 'text/plain' ELSE 'Text/HTML' END AS content_type,
       CASE WHEN page_id % 2 = 0 THEN html ELSE concat(html, '!') END AS html FROM pages
"""


def page_fetches(spark, sf) -> DataFrame:
    rows = run_sql(spark, sf, PAGE_FETCHES).withColumn("body", F.encode("html", "UTF-8")).drop("html")
    return limit_bodies(rows).withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))


@query(
    "soft404",
    """SELECT page_id, page_id % 2 = 0 AND page_id % 7 <> 0 AND page_id % 5 <> 0 AND octet_length(encode(html)) <= 4096 AS matches_control FROM pages""",
)
def soft404(spark, sf):
    rows = page_fetches(spark, sf)
    probes = rows.where(~outcomes.is_control())
    return outcomes.mark_soft404(probes, outcomes.control_signatures(rows)).select("page_id", "matches_control")


@query(
    "fetch_digest",
    """SELECT page_id, least(octet_length(encode(html)), 16384) AS byte_count, octet_length(encode(html)) > 16384 AS truncated,
              CASE WHEN octet_length(encode(html)) <= 16384 THEN sha256(html) END AS whole_sha256 FROM pages""",
)
def fetch_digest(spark, sf):
    rows = page_fetches(spark, sf).where("probe_key = 'robots_txt'")
    return rows.select("page_id", "byte_count", "truncated", F.when(~F.col("truncated"), F.col("body_sha256")).alias("whole_sha256"))


# fixed values, written out: what the SQL expects must not come from the code it checks
_LIGHT = "'robots_txt', 'sitemap_xml', 'llms_txt', 'llms_full_txt'"
_DISCOVERY = """'well_known_commerce', 'well_known_ucp', 'well_known_agent_json', 'well_known_agents_json', 'well_known_agent_card', 'root_agent_json',
  'openapi_json', 'x402_well_known', 'x402_json'"""
EXPECTED = f"{_LIGHT}, 'homepage', {_DISCOVERY}, 'products_json', 'cart_json', 'payment_probe'"
EARLY = "Skipped after repeated HTTP 429 responses during early discovery probes"
DISCOVERY = "Skipped after repeated HTTP 429 responses during discovery probes"
NO_SURFACE = "Skipped after repeated HTTP 429 responses without any valid machine-readable surface"
NO_HINT = "Skipped because homepage/UCP did not suggest a product catalog"
NO_CATALOG = "Skipped because no valid public catalog was detected"
NO_CANDIDATE = "Skipped because no payment probe candidate was discovered"
TIME = "Skipped after per-domain wall-clock limit was reached before discovery probe fetches completed"


# some receipts of the check answer 429 throughout, so every way of stopping occurs
LIMITED_LOG = f"""
SELECT pos, concat(domain, CASE WHEN user_id % 5 = 2 AND probe_key NOT IN ('homepage', 'robots_txt') THEN '.rest' ELSE '' END) AS domain, attempt, probe_key,
  CASE WHEN user_id % 5 = 0 AND probe_key IN ('robots_txt', 'sitemap_xml', 'llms_txt') THEN 'rate_limited'
  WHEN user_id % 5 = 1 AND status = 'valid' THEN 'rate_limited' ELSE status END AS status
FROM (SELECT f.*, {STATUS_OF_FETCH} AS status, CAST(regexp_extract(domain, '[0-9]+', 0) AS INT) AS user_id FROM ({FETCH_LOG}) f) o
"""
LAST_OUTCOME = f"SELECT domain, attempt, probe_key, arg_max(status, pos) AS status FROM ({LIMITED_LOG}) o GROUP BY domain, attempt, probe_key"


@query(
    "complete_outcomes",
    f"""WITH o AS ({LAST_OUTCOME}), n AS (SELECT domain, attempt, count(*) FILTER (WHERE status = 'rate_limited' AND probe_key IN ({_LIGHT})) AS light, count(*) FILTER (WHERE status = 'rate_limited') AS everything,
             count(*) FILTER (WHERE status = 'rate_limited' AND probe_key = 'homepage') AS home, count(*) FILTER (WHERE probe_key IN ({_DISCOVERY})) AS discovered,
             count(*) FILTER (WHERE status = 'valid' AND probe_key NOT IN ('homepage', 'robots_txt', 'sitemap_xml')) AS surfaces, count(*) FILTER (WHERE status = 'valid' AND probe_key = 'products_json') AS catalogs,
             CASE WHEN attempt <= 1 THEN 3 ELSE 5 END AS t FROM o GROUP BY domain, attempt),
        s AS (SELECT *, CASE WHEN surfaces > 0 THEN NULL WHEN light >= t THEN 'early' WHEN discovered = 0 AND (home > 0 OR everything >= t) THEN 'home' WHEN everything >= t THEN 'discovery' END AS stop FROM n)
        SELECT domain, attempt, probe_key, status, '' AS reason FROM o
        UNION ALL SELECT s.domain, s.attempt, k.probe_key, 'skipped', CASE WHEN stop = 'early' AND k.probe_key NOT IN ('products_json', 'cart_json', 'payment_probe') THEN '{EARLY}'
             WHEN stop = 'home' THEN '{NO_SURFACE}' WHEN stop = 'discovery' THEN '{DISCOVERY}' WHEN k.probe_key = 'products_json' THEN '{NO_HINT}'
             WHEN k.probe_key = 'cart_json' AND catalogs = 0 THEN '{NO_CATALOG}' WHEN k.probe_key = 'payment_probe' THEN '{NO_CANDIDATE}' ELSE '{TIME}' END
        FROM s, (SELECT unnest([{EXPECTED}]) AS probe_key) k WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.domain = s.domain AND o.attempt = s.attempt AND o.probe_key = k.probe_key)""",
)
def complete_outcomes(spark, sf):
    last = run_sql(spark, sf, LIMITED_LOG).groupBy("domain", "attempt", "probe_key").agg(F.max_by("status", "pos").alias("status"))
    full = outcomes.complete_outcomes(last)
    return full.select("domain", "attempt", "probe_key", "status", F.coalesce("detail", F.lit("")).alias("reason"))


# ---------------------------------------------------------------- bounded merges


@query(
    "ordered_merge",
    f"""SELECT conv_id, string_agg(word, '|' ORDER BY t) AS merged FROM (SELECT conv_id, word, t, row_number() OVER (PARTITION BY conv_id ORDER BY t) AS r
        FROM (SELECT conv_id, regexp_replace(word, '^\\s+|\\s+$', '', 'g') AS word, min((turn, role, place)) AS t FROM (SELECT conv_id, turn, role, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) - 1 AS place FROM conversations) w
              WHERE regexp_replace(word, '^\\s+|\\s+$', '', 'g') <> '' GROUP BY 1, 2) d) x WHERE r <= 12 GROUP BY conv_id""",
)
def ordered_merge(spark, sf):
    words = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.posexplode(F.split("text", " ", -1)).alias("place", "word"))
    merged = merges.ordered_merge(words, ["conv_id"], "word", ["turn", "role", "place"], 12)
    return merged.select("conv_id", F.array_join("merged", "|").alias("merged"))


ACTIONS = """
SELECT o_custkey, o_orderkey AS pos, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS source_rank, CASE o_orderstatus WHEN 'F' THEN 'GET' ELSE 'POST' END AS method,
       CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('https://a.example/', substr(o_orderpriority, 1, 1)) END AS url, concat('/', substr(o_orderpriority, 1, 1)) AS path,
       CAST(o_orderkey % 2 AS STRING) AS title FROM orders
"""


def _first_of(keys, limit):
    return f"""SELECT o_custkey, {', '.join(keys)}, place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY source_rank, pos) AS place
        FROM (SELECT * FROM ({ACTIONS}) a QUALIFY row_number() OVER (PARTITION BY o_custkey, {', '.join(k.split(' AS ')[0] for k in keys)} ORDER BY source_rank, pos) = 1) f) r WHERE place <= {limit}"""


@query("action_samples", _first_of(["method", "CASE WHEN url = '' THEN path ELSE url END AS target", "title"], 6))
def action_samples(spark, sf):
    rows = merges.action_samples(run_sql(spark, sf, ACTIONS), ["o_custkey"])
    return rows.select("o_custkey", "method", "target", "title", F.col("place").cast("bigint").alias("place"))


@query(
    "candidate_merge",
    f"""SELECT 'action' AS kind, o_custkey, method, url, place FROM ({_first_of(['method', 'url'], 6)}) x
        UNION ALL SELECT 'checkout', o_custkey, NULL, nullif(url, ''), place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY source_rank, pos) AS place
          FROM (SELECT * FROM ({ACTIONS}) a QUALIFY url = '' OR row_number() OVER (PARTITION BY o_custkey, url ORDER BY source_rank, pos) = 1) f) r WHERE place <= 8""",
)
def candidate_merge(spark, sf):
    rows = run_sql(spark, sf, ACTIONS)
    by_action = merges.probe_candidates(rows, ["o_custkey"]).select(F.lit("action").alias("kind"), "o_custkey", "method", "url", "place")
    by_url = merges.checkout_candidates(rows, ["o_custkey"]).select(
        F.lit("checkout").alias("kind"), "o_custkey", F.lit(None).cast("string").alias("method"), F.col("url_key").alias("url"), "place")
    return by_action.unionByName(by_url).withColumn("place", F.col("place").cast("bigint"))


OBSERVED = """
SELECT concat('site', CAST(user_id AS STRING)) AS domain, CASE event_id % 3 WHEN 0 THEN 'observed_payment_methods' WHEN 1 THEN 'observed_payment_assets' ELSE 'observed_capability_names' END AS fact_key,
       CAST(event_id % 4 AS INT) AS probe_rank, event_id AS pos, concat(' v', CAST(CAST(floor(value) AS INT) % 23 AS STRING), ' ') AS value,
       CASE WHEN event_type = 'error' THEN 'invalid' ELSE 'valid' END AS status FROM events
"""


@query(
    "observed_merge",
    f"""SELECT domain, fact_key, string_agg(v, ',' ORDER BY t) AS merged FROM (SELECT *, row_number() OVER (PARTITION BY domain, fact_key ORDER BY t) AS r
        FROM (SELECT domain, fact_key, trim(value) AS v, min((probe_rank, pos)) AS t FROM ({OBSERVED}) o WHERE status = 'valid' GROUP BY ALL) d) x WHERE r <= 12 GROUP BY ALL""",
)
def observed_merge(spark, sf):
    merged = merges.observed_merge(run_sql(spark, sf, OBSERVED), ["domain"])
    return merged.select("domain", "fact_key", F.array_join("merged", ",").alias("merged"))


UCP_PAIRS = """
SELECT o_orderkey, CAST(o_custkey % 5 AS INT) AS a, CAST(o_orderkey % 7 AS INT) AS b, o_orderstatus, substr(o_orderpriority, 1, 1) AS p FROM orders
"""


@query(
    "ucp_merge",
    f"""SELECT o_orderkey, CASE WHEN b = 0 THEN a ELSE greatest(a, b) END AS capability_count,
        CASE WHEN b = 0 THEN concat('c', a, ',x') ELSE array_to_string(list_sort(list_distinct([concat('c', a), 'x', concat('c', b)])), ',') END AS capability_names,
        CASE WHEN a = 0 AND b > 0 THEN concat('v', b) WHEN a > 0 THEN concat('v', a) END AS ucp_version, CASE WHEN b = 0 THEN a = 1 ELSE a = 1 OR b = 2 END AS crypto_only FROM ({UCP_PAIRS}) u""",
)
def ucp_merge(spark, sf):
    def side(c, names):
        empty = F.array().cast("array<string>")
        return F.struct(
            *[c.alias(n) for n in merges.UCP_COUNTS], *[(names if n == "capability_names" else empty).alias(n) for n in merges.UCP_LISTS],
            F.when(c > 0, F.concat(F.lit("v"), c.cast("string"))).alias("ucp_version"), F.lit(None).cast("string").alias("payment_surface"),
            F.lit(None).cast("string").alias("current_version_url"), (c == (1 if names is own else 2)).alias("crypto_only"),
        )

    a, b = F.col("a"), F.col("b")
    own = F.array(F.concat(F.lit("c"), a.cast("string")), F.lit("x"))
    other = F.array(F.concat(F.lit("c"), b.cast("string")))
    merged = run_sql(spark, sf, UCP_PAIRS).select("o_orderkey", merges.merge_ucp_facts(side(a, own), F.when(b > 0, side(b, other))).alias("m"))
    return merged.select(
        "o_orderkey", F.col("m.capability_count").cast("bigint").alias("capability_count"), F.array_join("m.capability_names", ",").alias("capability_names"),
        "m.ucp_version", "m.crypto_only")


@query(
    "checkout_enrich",
    f"""SELECT doc_id, greatest(coalesce(checkout_url_count, 0), doc_id % 4) AS checkout_url_count,
        CASE WHEN doc_id % 4 = 0 THEN coalesce(first_checkout, '') ELSE coalesce(first_checkout, 'https://u.example/1') END AS first_url,
        'Usable products catalog detected; enriched with UCP checkout data' AS detail FROM ({CATALOG_SQL}) c""",
)
def checkout_enrich(spark, sf):
    facts = catalog.product_facts(catalog_fetches(spark, sf)).where("is_valid")
    own = F.struct(F.col("facts.checkout_url_count").cast("bigint").alias("checkout_url_count"), F.col("facts.sample_checkout_urls").alias("sample_checkout_urls"), F.col("detail").alias("detail"))
    more = F.struct((F.col("doc_id") % 4).alias("checkout_url_count"), F.when(F.col("doc_id") % 4 > 0, F.array(F.lit(" https://u.example/1 "))).alias("sample_checkout_urls"))
    merged = facts.select("doc_id", merges.enrich_checkout(own, more).alias("m"))
    return merged.select("doc_id", "m.checkout_url_count", F.coalesce(F.get("m.sample_checkout_urls", F.lit(0)), F.lit("")).alias("first_url"), "m.detail")


# ---------------------------------------------------------------- payment candidates

CANDIDATES = """
SELECT o_custkey, o_orderkey AS pos, concat('https://a.example/', CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Buy' WHEN '2' THEN 'search/list' WHEN '3' THEN 'crawl' WHEN '4' THEN 'status' ELSE 'x' END) AS url,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Read' END AS title, CASE WHEN o_orderkey % 2 = 0 THEN '5' END AS amount, CASE o_orderkey % 3 WHEN 0 THEN 'object' WHEN 1 THEN 'other' END AS body_kind,
  CASE o_orderkey % 6 WHEN 0 THEN 'openapi' WHEN 1 THEN 'agent_x402' WHEN 2 THEN 'x402' WHEN 3 THEN 'ucp_catalog_checkout' WHEN 4 THEN 'catalog_checkout' ELSE 'agent_extension' END AS source,
  CASE o_orderkey % 4 WHEN 0 THEN 'openapi_json' WHEN 1 THEN 'x402_json' WHEN 2 THEN 'api_products' ELSE 'robots_txt' END AS probe_key,
  CASE o_orderkey % 10 WHEN 1 THEN 'payment_challenge' WHEN 2 THEN 'success_without_payment' ELSE 'input_validation' END AS probe_result
FROM orders
"""
CANDIDATE_SCORES = f"""
SELECT *, CASE probe_key WHEN 'openapi_json' THEN 1 WHEN 'api_products' THEN 2 ELSE 4 END AS kr,
  CASE substr(url, 19) WHEN 'Buy' THEN 50 WHEN 'search/list' THEN 40 WHEN 'crawl' THEN 20 ELSE 0 END - CASE WHEN substr(url, 19) IN ('search/list', 'status') OR title IS NOT NULL THEN 20 ELSE 0 END
  + CASE WHEN amount IS NOT NULL THEN 15 ELSE 0 END + CASE body_kind WHEN 'object' THEN 10 WHEN 'other' THEN 5 ELSE 0 END
  + CASE source WHEN 'openapi' THEN 10 WHEN 'agent_x402' THEN 8 WHEN 'x402' THEN 6 WHEN 'ucp_catalog_checkout' THEN 14 WHEN 'catalog_checkout' THEN 12 ELSE 0 END AS score
FROM ({CANDIDATES}) c WHERE probe_key <> 'robots_txt'
"""


@query(
    "candidate_rank",
    f"SELECT o_custkey, pos, CAST(score AS BIGINT) AS score, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, kr, pos) AS candidate_rank FROM ({CANDIDATE_SCORES}) s",
)
def candidate_rank(spark, sf):
    ranked = C.rank_candidates(run_sql(spark, sf, CANDIDATES), ["o_custkey"])
    return ranked.select("o_custkey", "pos", F.col("score").cast("bigint").alias("score"), "candidate_rank")


@query(
    "chosen_candidate",
    f"""SELECT o_custkey, pos, probe_result FROM ({CANDIDATE_SCORES}) s
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN probe_result = 'input_validation' THEN 1 ELSE 0 END, score DESC, kr, pos) = 1""",
)
def chosen_candidate(spark, sf):
    return C.chosen_candidate(run_sql(spark, sf, CANDIDATES), ["o_custkey"]).select("o_custkey", "pos", "probe_result")


@query(
    "template_resolve",
    """WITH f AS (SELECT o_custkey, min(o_orderkey) AS k FROM orders GROUP BY 1), i AS (SELECT f.o_custkey, k, round_even(o_totalprice, 0) AS price FROM f JOIN orders o ON o.o_orderkey = f.k)
       SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN concat('https://h', c_custkey, '.example/u/sample-name') WHEN 1 THEN 'https://plain.example/x' WHEN 2 THEN CASE WHEN k IS NOT NULL THEN concat('https://h', c_custkey, '.example/o/', k, '/pay') END END AS resolved_url,
              CASE WHEN c_custkey % 4 = 2 AND k IS NOT NULL THEN concat('Order ', k) END AS sample_title, CASE WHEN c_custkey % 4 = 2 AND k IS NOT NULL THEN CAST(CAST(price AS BIGINT) AS VARCHAR) END AS sample_amount
       FROM customer LEFT JOIN i ON i.o_custkey = c_custkey""",
)
def template_resolve(spark, sf):
    wanted = run_sql(spark, sf, """SELECT c_custkey, 1 AS candidate_id, CASE c_custkey % 4 WHEN 0 THEN concat('https://h', CAST(c_custkey AS STRING), '.example/u/{slug}') WHEN 1 THEN 'https://plain.example/x'
        WHEN 2 THEN concat('https://h', CAST(c_custkey AS STRING), '.example/o/{order_id}/pay') ELSE 'https://h.example/:thing' END AS url FROM customer""")
    urls = F.when(F.col("c_custkey") % 4 == 2, F.array(F.lit("https://none.example"), F.concat(F.lit("https://h"), F.col("c_custkey").cast("string"), F.lit(".example/o")))).otherwise(F.array().cast("array<string>"))
    item = F.struct(F.col("o_orderkey").alias("orderId"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("name"), F.rint("o_totalprice").alias("price"))
    listed = table(spark, sf, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", item.alias("i")))).alias("xs"))
    body = F.to_json(F.struct(F.struct(F.concat(F.array(F.struct(F.lit(None).cast("long").alias("orderId"), F.lit("skip").alias("name"), F.lit(0.0).alias("price"))), F.transform("xs", lambda x: x["i"])).alias("orders")).alias("data")))
    found = listed.select(F.col("o_custkey").alias("c_custkey"), F.concat(F.lit("https://h"), F.col("o_custkey").cast("string"), F.lit(".example/o")).alias("discovery_url"), F.lit(200).alias("http_status"), body.alias("body"))
    rows = C.resolve_templates(wanted.withColumn("discovery_urls", urls), found, ["c_custkey"])
    return rows.select("c_custkey", "resolved_url", "sample_title", "sample_amount")


# fixed values, written out
STOPWORDS = """'about', 'buy', 'collection', 'collections', 'free', 'gift', 'gifts', 'home', 'kids', 'life', 'luxury', 'mens', 'online', 'official', 'sale',
  'shop', 'shopping', 'site', 'store', 'style', 'styles'"""


@query(
    "catalog_queries",
    f"""SELECT page_id, array_to_string(list_filter(ws, lambda x, i: list_position(ws, x) = i)[1:3], ',') AS queries FROM
        (SELECT page_id, list_filter(regexp_extract_all(lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '[a-z]{{4,}}'), lambda w: w NOT IN ({STOPWORDS})) AS ws FROM pages) p""",
)
def catalog_queries(spark, sf):
    asked = C.catalog_queries(title_of(F.col("html")))
    return table(spark, sf, "pages").select("page_id", F.array_join(asked, ",").alias("queries"))


@query(
    "sample_body",
    f"""SELECT pos, CASE WHEN method = 'GET' THEN NULL WHEN url LIKE '%/search/list' THEN '{{"q":"openai"}}' WHEN url LIKE '%crawl' THEN '{{"url":"https://example.com","maxPages":1}}' ELSE '{{}}' END AS body,
        CASE WHEN method = 'GET' THEN NULL WHEN url LIKE '%/search/list' OR url LIKE '%crawl' THEN 'object' ELSE 'other' END AS body_kind
        FROM (SELECT *, CASE WHEN pos % 2 = 0 THEN 'GET' ELSE 'put' END AS method FROM ({CANDIDATES}) c) x""",
)
def sample_body(spark, sf):
    rows = run_sql(spark, sf, f"SELECT *, CASE WHEN pos % 2 = 0 THEN 'GET' ELSE 'put' END AS method FROM ({CANDIDATES}) c")
    body = C.example_body(F.col("url"), F.col("method"))
    return rows.select("pos", body.alias("body"), C.body_kind(body).alias("body_kind"))


SCORED_ANSWERS = f"""
SELECT doc_id % 50 AS site, doc_id, doc_id % 3 AS endpoint_rank, doc_id AS query_rank, CASE WHEN doc_id % 5 = 0 THEN 0 ELSE 150 END + CASE WHEN product_count > 0 THEN 10 ELSE 0 END + 5 * product_count AS score FROM ({CATALOG_SQL}) c
"""


@query(
    "best_catalog",
    f"SELECT site, doc_id, CAST(score AS BIGINT) AS score FROM ({SCORED_ANSWERS}) s QUALIFY row_number() OVER (PARTITION BY site ORDER BY CASE WHEN score >= 150 THEN 0 ELSE 1 END, CASE WHEN score >= 150 THEN 0 ELSE -score END, endpoint_rank, query_rank) = 1",
)
def best_catalog(spark, sf):
    facts = catalog.tool_product_facts(tool_answers(spark, sf))
    priceless = F.col("doc_id") % 5 == 0
    seen = F.struct(
        F.when(~priceless, F.col("facts.max_price")).alias("max_price"), F.when(~priceless, F.col("facts.priced_variant_count")).alias("priced_variant_count"),
        F.col("facts.product_count").alias("product_count"), F.size("facts.sample_products").alias("sample_count"))
    answers = facts.select(
        (F.col("doc_id") % 50).alias("site"), "doc_id", C.catalog_score(seen).cast("bigint").alias("score"), (F.col("doc_id") % 3).alias("endpoint_rank"), F.col("doc_id").alias("query_rank"))
    return C.best_catalog(answers, ["site"]).select("site", "doc_id", "score")


@query(
    "remote_urls",
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'https://a.example/x' WHEN 1 THEN 'https://a.example/x,https://b.example/y' ELSE concat('https://a.example/x,https://n', c_nationkey, '.example/z') END AS urls FROM customer""",
)
def remote_urls(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.concat(F.lit("h"), F.col("c_custkey").cast("string"), F.lit(".example")).alias("domain"))
    own = F.concat(F.lit("https://"), F.col("domain"), F.lit("/.well-known/x402"))
    llms, full = F.array(own, F.lit(" https://a.example/x")), F.when(F.col("c_custkey") % 3 == 1, F.array(F.lit("https://b.example/y"), F.lit("https://a.example/x")))
    named = F.when(F.col("c_custkey") % 3 == 2, F.concat(F.lit("https://n"), F.col("c_nationkey").cast("string"), F.lit(".example/z")))
    urls = merges.remote_x402_urls(F.col("domain"), llms, full, named, F.array(F.concat(own, F.lit(".json")), named))
    return rows.select("c_custkey", F.array_join(urls, ",").alias("urls"))


# ---------------------------------------------------------------- classification

PROBE_CASE = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(V.PROBE_ORDER))
# every event is the outcome of one probe; its facts are simple functions of v
OUTCOME_LOG = f"""
SELECT event_id AS pos, concat('site', CAST(user_id AS STRING), '-', CAST(CAST(floor((day(ts) - 1) / 7) AS INT) AS STRING), '.example') AS domain,
       CASE event_id % 20 {PROBE_CASE} END AS probe_key,
       CASE event_type WHEN 'view' THEN 'valid' WHEN 'purchase' THEN 'valid' WHEN 'click' THEN 'missing' WHEN 'signup' THEN 'rate_limited' ELSE 'error' END AS status,
       CAST(floor(event_id / 20) AS BIGINT) AS v
FROM events
"""
RESULTS = ["payment_challenge", "success_without_payment", "browser_checkout_redirect", "auth_or_method_boundary", "input_validation", "temporary_failure", "browser_checkout_handoff"]


def facts_of_v():
    """Facts of an outcome as a variant; the same members for every probe."""
    v = F.col("v")
    when = lambda test, value: F.when(test, F.lit(value))
    action = F.struct(F.lit("GET").alias("method"), F.concat(F.lit("/a"), (v % 3).cast("string")).alias("url"), F.lit("t").alias("title"))
    result = F.lit(None).cast("string")
    for i, r in enumerate(RESULTS):
        result = F.when(v % 8 == i, r).otherwise(result)
    product = F.struct(F.concat(F.lit("h"), (v % 9).cast("string")).alias("handle"), (v % 7).cast("double").alias("min_price"))
    return F.to_variant_object(F.struct(
        F.concat(F.lit("T"), v.cast("string")).alias("title"), (v % 3 == 0).alias("shopify_hint"), (v % 3).alias("priced_offer_count"), (v % 2).alias("purchase_intent_url_count"),
        F.when(v % 4 == 0, 1).otherwise(0).alias("live_machine_payment_path_count"), (v % 7 == 0).alias("prelaunch"), when(v % 5 == 0, "https://c.example/").alias("checkout_url"),
        when(v % 4 == 1, "none").when(v % 4 == 2, " Bearer ").when(v % 4 == 3, "wallet").alias("purchase_intent_auth"),
        when(v % 3 == 1, "saved_card_authority").when(v % 3 == 2, "standard_checkout").alias("payment_surface"),
        F.array(F.concat(F.lit("p"), (v % 4).cast("string")), F.lit("stripe")).alias("payment_provider_hints"), (v % 6 == 0).alias("crypto_only"),
        (v % 2).alias("payment_required_operation_count"), F.when(v % 3 == 0, F.array(F.lit("key"))).otherwise(F.array().cast("array<string>")).alias("auth_schemes"),
        (v % 2).alias("accept_count"), (v % 5).alias("priced_action_count"), result.alias("probe_result"), (v % 2).alias("checkout_url_count"),
        F.array(action).alias("sample_actions"), F.array(product).alias("sample_products"), F.array(F.lit("EUR")).alias("currency_codes"),
        F.array(F.concat(F.lit("https://e"), (v % 4).cast("string"))).alias("public_endpoint_urls"), F.concat(F.lit("https://s"), v.cast("string")).alias("service_url"),
        (v % 11).cast("int").alias("product_count"), F.array(F.concat(F.lit("m"), (v % 4).cast("string"))).alias("observed_payment_methods"),
    ))


def outcome_log(spark, sf) -> DataFrame:
    return run_sql(spark, sf, OUTCOME_LOG).withColumn("facts", facts_of_v())


def receipts(spark, sf) -> DataFrame:
    return classify.pivot_outcomes(outcome_log(spark, sf), ["domain"], ["status", "facts"])


def rows(spark, sf) -> DataFrame:
    return classify.classified(receipts(spark, sf))


_PIVOT = ", ".join(f"max(s) FILTER (WHERE probe_key = '{k}') AS s_{k}, max(v) FILTER (WHERE probe_key = '{k}' AND s = 'valid') AS v_{k}, max(v) FILTER (WHERE probe_key = '{k}') AS a_{k}" for k in V.PROBE_ORDER)
_LIMITED = " OR ".join(f"coalesce(s_{k} = 'rate_limited', false)" for k in V.PROBE_ORDER)
_CALLABLE = " OR ".join(f"v_{k} IS NOT NULL" for k in V.CALLABLE_PROBES)
_RESULT = "CASE p % 8 " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(RESULTS)) + " END"
_AUTH = "CASE c % 4 WHEN 1 THEN 'none' WHEN 2 THEN 'bearer' WHEN 3 THEN 'wallet' END"
_NEEDS = f"coalesce({_AUTH} <> 'none', false)"
CLASSIFIED = f"""
WITH l AS (SELECT domain, probe_key, arg_max(status, pos) AS s, arg_max(v, pos) AS v FROM ({OUTCOME_LOG}) o GROUP BY ALL),
w AS (SELECT domain, {_PIVOT} FROM l GROUP BY domain),
d AS (SELECT *, coalesce(v_products_json, v_api_products) AS pr, coalesce(v_openapi_json, v_api_openapi_json) AS o, coalesce(v_x402_json, v_x402_well_known, v_remote_x402) AS x,
      v_well_known_commerce AS c, v_well_known_ucp AS u, v_payment_probe AS p, {_LIMITED} AS limited FROM w),
e AS (SELECT *, x IS NOT NULL AS actionable, {_RESULT} AS result,
      c IS NOT NULL AND c % 3 > 0 AND c % 2 > 0 AND ((coalesce(o, 0) % 2 > 0) OR {_NEEDS}) AND c % 7 <> 0 AS claim,
      coalesce(pr % 2 > 0, false) OR coalesce(c % 5 = 0, false) OR coalesce({_RESULT} LIKE 'browser%', false) AS checkout FROM d),
f AS (SELECT *, list_concat({', '.join(f"CASE WHEN v_{k} IS NOT NULL THEN [concat('p', v_{k} % 4), 'stripe'] ELSE [] END" for k in V.AGENT_DOCUMENTS)},
        CASE WHEN c IS NOT NULL THEN [concat('p', c % 4), 'stripe'] ELSE [] END, CASE WHEN u IS NOT NULL THEN [concat('p', u % 4), 'stripe'] ELSE [] END,
        CASE WHEN x IS NOT NULL THEN [concat('p', x % 4), 'stripe'] ELSE [] END, CASE WHEN actionable THEN ['x402'] ELSE [] END, CASE WHEN p IS NOT NULL THEN [concat('p', p % 4), 'stripe'] ELSE [] END) AS prov,
      CASE WHEN actionable THEN 'x402' ELSE coalesce({', '.join(f"CASE v_{k} % 3 WHEN 1 THEN 'saved_card_authority' WHEN 2 THEN 'standard_checkout' END" for k in V.AGENT_DOCUMENTS + ['well_known_commerce', 'well_known_ucp', 'payment_probe'])}) END AS surface,
      {' OR '.join(f"coalesce(v_{k} % 6 = 0, false)" for k in V.AGENT_DOCUMENTS + ['well_known_commerce', 'well_known_ucp', 'payment_probe'])} OR coalesce(x % 6 = 0, false) AS crypto,
      greatest({', '.join(f"coalesce(v_{k} % 5, 0)" for k in V.AGENT_DOCUMENTS)}, coalesce(x % 5, 0)) AS priced FROM e),
g AS (SELECT *, list_filter([
        CASE WHEN v_llms_txt IS NOT NULL OR v_llms_full_txt IS NOT NULL THEN 'ai_readable' END, CASE WHEN checkout THEN 'browser_checkout_surface' END,
        CASE WHEN {_CALLABLE} OR (p IS NOT NULL AND coalesce(result NOT LIKE 'browser%', true)) THEN 'callable_surface' END, CASE WHEN u IS NOT NULL OR pr IS NOT NULL THEN 'catalog_surface' END,
        CASE WHEN v_robots_txt IS NOT NULL AND v_sitemap_xml IS NOT NULL THEN 'crawl_basics' END, CASE WHEN result = 'success_without_payment' THEN 'free_tier_or_optional_payment' END,
        CASE WHEN actionable OR claim OR result IN ('payment_challenge', 'success_without_payment') THEN 'machine_payable' END, CASE WHEN c % 3 > 0 THEN 'offer_surface' END,
        CASE WHEN c % 7 = 0 THEN 'prelaunch_offer_surface' END, CASE WHEN limited THEN 'rate_limited' END, CASE WHEN a_homepage % 3 = 0 THEN 'shopify_hint' END,
        CASE WHEN result IN ('payment_challenge', 'success_without_payment') THEN 'verified_payment_surface' END], lambda t: t IS NOT NULL) AS tags FROM f)
SELECT *, CASE WHEN list_contains(tags, 'machine_payable') THEN 'machine_payable' WHEN list_contains(tags, 'offer_surface') THEN 'offer_surface' WHEN list_contains(tags, 'callable_surface') THEN 'callable_surface'
    WHEN list_contains(tags, 'catalog_surface') THEN 'catalog_surface' WHEN list_contains(tags, 'ai_readable') THEN 'ai_readable' WHEN limited THEN 'rate_limited' WHEN s_homepage = 'error' THEN 'unreachable'
    WHEN list_contains(tags, 'crawl_basics') THEN 'crawl_basics_only' ELSE 'no_clear_signal' END AS label FROM g
"""


@query("tags", f"SELECT domain, array_to_string(tags, ',') AS tags FROM ({CLASSIFIED}) z")
def tags(spark, sf):
    return rows(spark, sf).select("domain", F.array_join("tags", ",").alias("tags"))


@query("label", f"SELECT domain, label FROM ({CLASSIFIED}) z")
def label(spark, sf):
    return rows(spark, sf).select("domain", "label")


@query("payable_claim", f"SELECT domain, claim FROM ({CLASSIFIED}) z")
def payable_claim(spark, sf):
    return rows(spark, sf).select("domain", F.col("_claim").alias("claim"))


@query("x402_actionable", f"SELECT domain, actionable FROM ({CLASSIFIED}) z")
def x402_actionable(spark, sf):
    return rows(spark, sf).select("domain", F.col("_actionable").alias("actionable"))


@query(
    "purchase_boundary",
    f"""SELECT domain, CASE WHEN result = 'payment_challenge' THEN result WHEN result = 'success_without_payment' THEN 'optional_or_prepaid_payment' WHEN result LIKE 'browser%' THEN 'checkout_redirect'
        WHEN result = 'auth_or_method_boundary' THEN 'auth_boundary' WHEN result = 'input_validation' THEN 'input_validation_boundary' WHEN c % 5 = 0 THEN 'checkout_redirect'
        WHEN c % 3 > 0 AND c % 2 > 0 THEN 'purchase_intent_documented' WHEN c % 3 > 0 THEN 'offer_documented' WHEN checkout AND (pr IS NOT NULL OR c IS NOT NULL) THEN 'checkout_redirect'
        WHEN pr IS NOT NULL THEN 'catalog_only' WHEN list_contains(tags, 'ai_readable') THEN 'read_only' WHEN list_contains(tags, 'crawl_basics') THEN 'crawl_only' ELSE 'unknown' END AS purchase_boundary FROM ({CLASSIFIED}) z""",
)
def purchase_boundary(spark, sf):
    return rows(spark, sf).select("domain", "purchase_boundary")


@query(
    "control_boundary",
    f"""SELECT domain, CASE WHEN c % 4 = 3 THEN 'wallet_required' WHEN c % 4 = 2 THEN 'token_required' WHEN result = 'success_without_payment' THEN 'none'
        WHEN result = 'payment_challenge' THEN CASE WHEN surface = 'saved_card_authority' THEN 'owner_preauthorized_card' WHEN crypto THEN 'wallet_required' ELSE 'payment_required' END
        WHEN result = 'auth_or_method_boundary' THEN CASE WHEN crypto THEN 'wallet_required' WHEN o % 3 = 0 THEN 'token_required' ELSE 'auth_required' END
        WHEN result = 'input_validation' THEN 'input_required' WHEN surface = 'saved_card_authority' THEN 'owner_preauthorized_card' WHEN crypto THEN 'wallet_required'
        WHEN o % 3 = 0 THEN 'token_required' WHEN checkout THEN 'human_checkout' ELSE 'unknown' END AS control_boundary FROM ({CLASSIFIED}) z""",
)
def control_boundary(spark, sf):
    return rows(spark, sf).select("domain", "control_boundary")


@query(
    "payment_rollup",
    f"""SELECT domain, array_to_string(list_filter(prov, lambda q, i: list_position(prov, q) = i)[1:12], ',') AS providers, surface AS payment_surface, crypto AS crypto_only, CAST(priced AS BIGINT) AS priced_action_count,
        coalesce(array_to_string(CASE WHEN actionable THEN ['x402'] ELSE [] END, ','), '') AS rails FROM ({CLASSIFIED}) z""",
)
def payment_rollup(spark, sf):
    return rows(spark, sf).select(
        "domain", F.array_join("payment_provider_hints", ",").alias("providers"), "payment_surface", "crypto_only", "priced_action_count", F.array_join("payment_rail_hints", ",").alias("rails"))


_AGENT_V = [f"v_{k}" for k in V.AGENT_DOCUMENTS]


@query(
    "agent_merge",
    f"""SELECT domain, array_to_string(list_filter(us, lambda q, i: list_position(us, q) = i), ',') AS urls, CASE WHEN coalesce({', '.join(_AGENT_V)}) IS NOT NULL THEN concat('https://s', coalesce({', '.join(_AGENT_V)})) END AS service_url,
        nullif(greatest({', '.join(f'coalesce({x} % 5, 0)' for x in _AGENT_V)}), 0)::BIGINT AS priced FROM
        (SELECT *, list_concat({', '.join(f"CASE WHEN {x} IS NOT NULL THEN [concat('https://e', {x} % 4)] ELSE [] END" for x in _AGENT_V)}) AS us FROM ({CLASSIFIED}) z) y""",
)
def agent_merge(spark, sf):
    merged = receipts(spark, sf).select("domain", merges.merge_agent_facts([classify.valid([k]) for k in V.AGENT_DOCUMENTS]).alias("a"))
    return merged.select("domain", F.array_join("a.public_endpoint_urls", ",").alias("urls"), "a.service_url", F.col("a.priced_action_count").alias("priced"))


@query(
    "best_outcome",
    f"""SELECT domain, CASE WHEN v_openapi_json IS NOT NULL THEN 'openapi_json' WHEN v_api_openapi_json IS NOT NULL THEN 'api_openapi_json' END AS valid_choice,
        CASE WHEN v_remote_x402 IS NOT NULL OR v_x402_json IS NOT NULL OR v_x402_well_known IS NOT NULL THEN 'valid' ELSE coalesce(s_remote_x402, s_x402_json, s_x402_well_known) END AS public_status FROM ({CLASSIFIED}) z""",
)
def best_outcome(spark, sf):
    r = receipts(spark, sf)
    v = scoring.best_outcome(["openapi_json", "api_openapi_json"], fall_back=False)
    own, other = F.col("probes.openapi_json"), F.col("probes.api_openapi_json")
    choice = F.when(v.isNull(), None).when(own["status"] == "valid", "openapi_json").when(other["status"] == "valid", "api_openapi_json")
    return r.select("domain", choice.alias("valid_choice"), scoring.best_outcome(["remote_x402", "x402_json", "x402_well_known"])["status"].alias("public_status"))


@query(
    "aggregates",
    f"""SELECT domain, CASE WHEN pr IS NOT NULL THEN concat('https://', domain, '/products/h', pr % 9) END AS product_url, CASE WHEN pr IS NOT NULL THEN 'EUR' END AS product_currency, CASE WHEN pr IS NOT NULL THEN pr % 11 END AS product_count,
        o % 2 AS openapi_paid, c % 3 AS commerce_priced, x % 2 AS x402_accepts, result AS probe_result, CASE WHEN coalesce({', '.join(_AGENT_V)}) IS NOT NULL THEN concat('https://s', coalesce({', '.join(_AGENT_V)})) END AS agent_service,
        CASE WHEN a_homepage IS NOT NULL THEN concat('T', a_homepage) END AS title, label, nullif(priced, 0)::BIGINT AS priced_action_count FROM ({CLASSIFIED}) z""",
)
def aggregates(spark, sf):
    r = classify.as_document(classify.receipts_of(rows(spark, sf), ["domain"]))
    a = lambda path, t: F.try_variant_get("aggregates", f"$.{path}", t)
    return r.select(
        "domain", a("sample_products[0].product_url", "string").alias("product_url"), a("sample_products[0].currency", "string").alias("product_currency"), a("product_count", "bigint").alias("product_count"),
        a("openapi_payment_required_operation_count", "bigint").alias("openapi_paid"), a("commerce_priced_offer_count", "bigint").alias("commerce_priced"), a("x402_accept_count", "bigint").alias("x402_accepts"),
        a("payment_probe_probe_result", "string").alias("probe_result"), a("agent_service_url", "string").alias("agent_service"), "title", "label", a("priced_action_count", "bigint").alias("priced_action_count"),
    )


@query(
    "catalog_hint",
    "SELECT page_id, page_id % 7 = 0 OR page_id % 5 = 0 OR contains(lower(html), 'shopify') AS wanted FROM pages",
)
def catalog_hint(spark, sf):
    p = F.col("page_id")
    return table(spark, sf, "pages").select("page_id", classify.catalog_hint(F.col("html"), p % 5 == 0, p % 7 == 0).alias("wanted"))
