"""Domain lists, receipt logs, selection, publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.base import FETCH_LOG, RECEIPT_LOG, STATUS_OF_FETCH, query, run_sql, spread_out, table
from signpost import values as V
from signpost.operators import counters, publish, rerun, scoring, select
from signpost.session import scratch_path
from signpost.sources import domain_list as DL
from signpost.sources import evidence as EV
from signpost.sources import position as P
from signpost.sources import receipts as R

# ---------------------------------------------------------------- domain lists

LIST_LINES = """
SELECT CAST(c_custkey AS BIGINT) AS row_index,
       CASE c_custkey % 8
         WHEN 0 THEN concat(CAST(c_custkey AS STRING), ',Shop', CAST(c_custkey AS STRING), '.Example.COM.')
         WHEN 1 THEN concat(CAST(c_custkey AS STRING), chr(9), 'tab', CAST(c_custkey AS STRING), '.example')
         WHEN 2 THEN concat(CAST(c_custkey AS STRING), '   blank', CAST(c_custkey AS STRING), '.example/path')
         WHEN 3 THEN concat('https://user@host', CAST(c_custkey AS STRING), '.example:8443/x?y')
         WHEN 4 THEN concat('bare', CAST(c_custkey AS STRING), '.example')
         WHEN 5 THEN 'Domain'
         WHEN 6 THEN concat(CAST(c_custkey AS STRING), ',bad..', CAST(c_custkey AS STRING), '.example')
         ELSE '' END AS line
FROM customer
"""
DOMAIN_LIST = """
SELECT CAST(c_custkey AS BIGINT) AS row_index,
       CASE WHEN c_custkey % 8 IN (0, 1, 2) THEN CAST(c_custkey AS INT) END AS rank,
       CASE c_custkey % 8
         WHEN 0 THEN concat('shop', CAST(c_custkey AS STRING), '.example.com')
         WHEN 1 THEN concat('tab', CAST(c_custkey AS STRING), '.example')
         WHEN 2 THEN concat('blank', CAST(c_custkey AS STRING), '.example')
         WHEN 3 THEN concat('host', CAST(c_custkey AS STRING), '.example')
         ELSE concat('bare', CAST(c_custkey AS STRING), '.example') END AS domain
FROM customer WHERE c_custkey % 8 IN (0, 1, 2, 3, 4)
"""


def customer_domains(spark: SparkSession, sf: str) -> DataFrame:
    return DL.parse_domains(run_sql(spark, sf, LIST_LINES))


@query("domain_list", DOMAIN_LIST)
def domain_list(spark, sf):
    """The list goes through real text files, so positions come from the files."""
    path = scratch_path(spark, "list")
    lines = run_sql(spark, sf, LIST_LINES)
    lines.repartitionByRange(3, "row_index").sortWithinPartitions("row_index").select("line").write.text(path)
    return DL.read_domain_list(spark, path)


RECORDS = """
SELECT c_custkey, CASE c_custkey % 4
         WHEN 0 THEN concat(CAST(c_custkey AS STRING), ',"shop', CAST(c_custkey AS STRING), '.example","a note', chr(10), 'over ""two"" lines, or', chr(10), chr(10), 'more"')
         WHEN 1 THEN concat('"', CAST(c_custkey AS STRING), '","', chr(10), 'host', CAST(c_custkey AS STRING), '.example', chr(10), '"')
         WHEN 2 THEN concat('bare', CAST(c_custkey AS STRING), '.example,5" wide')
         ELSE '' END AS line
FROM customer
"""


@query(
    "domain_records",
    """SELECT row_index, CASE WHEN n % 4 < 2 THEN n END::INT AS rank, CASE n % 4 WHEN 0 THEN concat('shop', n, '.example') WHEN 1 THEN concat('host', n, '.example') ELSE concat('bare', n, '.example') END AS domain
       FROM (SELECT c_custkey AS n, row_number() OVER (ORDER BY c_custkey) - 1 AS row_index FROM customer) c WHERE n % 4 <> 3""",
)
def domain_records(spark, sf):
    """A list with line breaks in quoted cells, in several files."""
    path = scratch_path(spark, "records")
    run_sql(spark, sf, RECORDS).repartitionByRange(3, "c_custkey").sortWithinPartitions("c_custkey").select("line").write.text(path)
    return DL.read_domain_list(spark, path)


@query(
    "global_position",
    "SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS row_index, concat('e', CAST(event_id AS STRING)) AS line FROM events",
)
def global_position(spark, sf):
    path = scratch_path(spark, "lines")
    rows = table(spark, sf, "events").select("event_id", F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("line"))
    rows.repartitionByRange(5, "event_id").sortWithinPartitions("event_id").select("line").write.text(path)
    return P.numbered_lines(spark, path)


@query("resume_offset", f"SELECT * FROM ({DOMAIN_LIST}) d WHERE row_index >= 500")
def resume_offset(spark, sf):
    return DL.from_offset(customer_domains(spark, sf), 500)


@query("domain_limit", f"SELECT * FROM ({DOMAIN_LIST}) d ORDER BY row_index LIMIT 100")
def domain_limit(spark, sf):
    return DL.limited(customer_domains(spark, sf), 100)


# orders stand for receipts of listed domains
ORDER_RECEIPTS = """
SELECT o_orderkey AS pos,
       concat(' ', CASE o_custkey % 8
         WHEN 0 THEN concat('SHOP', CAST(o_custkey AS STRING), '.example.com')
         WHEN 1 THEN concat('tab', CAST(o_custkey AS STRING), '.example')
         WHEN 2 THEN concat('blank', CAST(o_custkey AS STRING), '.example')
         WHEN 3 THEN concat('host', CAST(o_custkey AS STRING), '.example')
         ELSE concat('bare', CAST(o_custkey AS STRING), '.example') END,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW') THEN '' ELSE '.unlisted' END) AS domain
FROM orders
"""


@query(
    "unseen_domains",
    f"SELECT * FROM ({DOMAIN_LIST}) d WHERE domain NOT IN (SELECT lower(trim(domain)) FROM ({ORDER_RECEIPTS}) r)",
)
def unseen_domains(spark, sf):
    return R.unseen(customer_domains(spark, sf), run_sql(spark, sf, ORDER_RECEIPTS)).select("row_index", "rank", "domain")


# ---------------------------------------------------------------- receipt log

FLAG_PROBE = {
    "robots_present": "robots_txt", "sitemap_present": "sitemap_xml", "llms_present": "llms_txt",
    "llms_full_present": "llms_full_txt", "openapi_present": "api_openapi_json",
    "agent_present": "root_agent_json", "agent_card_present": "well_known_agent_card",
    "ucp_present": "well_known_ucp", "commerce_present": "well_known_commerce",
    "x402_present": "remote_x402", "products_present": "products_json",
}
CRAWLED_AT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def receipt_rows(spark: SparkSession, sf: str) -> DataFrame:
    return run_sql(spark, sf, RECEIPT_LOG).withColumn("crawled_at", F.date_format("ts", CRAWLED_AT))


def receipt_lines(spark: SparkSession, sf: str) -> DataFrame:
    """(pos, line): the receipt of each event as a JSON log line."""
    def outcome(flag):
        return F.struct(
            F.when(F.col(flag), "valid").otherwise("missing").alias("status"),
            F.when(F.col(flag), 200).otherwise(404).alias("http_status"),
            F.concat(F.lit("d"), F.col("pos").cast("string")).alias("detail"),
        )

    probes = F.struct(*[outcome(flag).alias(key) for flag, key in FLAG_PROBE.items()])
    aggregates = F.struct(
        "verified_payment_surface", "payment_surface", "product_count", "priced_action_count", "crypto_only",
        "purchase_boundary", "control_boundary",
        F.col("offer_count").alias("commerce_offer_count"), F.lit(7).alias("offer_count"),
        F.when(F.col("has_sample_offers"), F.array(F.struct(F.lit("o").alias("id")))).alias("sample_offers"),
        F.when(F.col("has_sample_products"), F.array(F.struct(F.lit("p").alias("title")))).alias("sample_products"),
        F.array(F.lit(" card "), F.col("label"), F.lit("card"), F.lit("")).alias("payment_rail_hints"),
    )
    line = F.to_json(
        F.struct(
            "domain", "rank", F.col("pos").alias("row_index"), "crawled_at", "label",
            F.array(F.col("label"), F.lit("crawl_basics")).alias("tags"),
            F.concat(F.lit("Site "), F.col("domain")).alias("title"),
            aggregates.alias("aggregates"), probes.alias("probes"),
        )
    )
    return spread_out(receipt_rows(spark, sf)).select("pos", line.alias("line"))


def receipt_log(spark: SparkSession, sf: str) -> DataFrame:
    return R.parse_receipt_lines(receipt_lines(spark, sf), strict=True)


@query(
    "receipt_scan",
    f"""SELECT row_number() OVER (ORDER BY pos) - 1 AS place, domain, CAST(rank AS BIGINT) AS rank, label,
               CAST(product_count AS BIGINT) AS product_count, llms_present AS llms_valid
        FROM ({RECEIPT_LOG}) r WHERE pos % 97 <> 5""",
)
def receipt_scan(spark, sf):
    """Shards with blank and broken lines, read leniently; append order must survive."""
    path = scratch_path(spark, "receipts")
    broken = receipt_lines(spark, sf).withColumn("line", F.when(F.col("pos") % 97 == 5, '{"domain": "cut').otherwise(F.col("line")))
    blanks = broken.withColumn("line", F.when(F.col("pos") % 10 == 0, F.concat("line", F.lit("\n  "))).otherwise(F.col("line")))
    blanks.repartitionByRange(4, "pos").sortWithinPartitions("pos").select("line").write.text(path)
    log = R.read_receipts(spark, path, strict=False)
    placed = P.number_sorted(
        log.select(
            "pos", "domain", F.try_variant_get("rank", "$", "bigint").alias("rank"), "label",
            F.try_variant_get("aggregates", "$.product_count", "bigint").alias("product_count"),
            (R.probe_status("llms_txt") == "valid").alias("llms_valid"),
        ),
        [F.col("pos").asc()], "place",
    )
    return placed.withColumn("place", F.col("place") - 1).drop("pos")


# ---------------------------------------------------------------- flags, scores, index

SCORED = f"""
SELECT *, CAST(round_even(score_readable * 0.3 + score_callable * 0.25 + score_commerce * 0.25 + score_payment * 0.2, 0) AS BIGINT) AS score_overall
FROM (
  SELECT r.*,
    least(100, robots_present::INT * 10 + sitemap_present::INT * 10 + llms_present::INT * 45 + llms_full_present::INT * 35) AS score_readable,
    least(100, openapi_present::INT * 40 + agent_present::INT * 25 + agent_card_present::INT * 15 + commerce_present::INT * 10 + x402_present::INT * 10) AS score_callable,
    least(100, products_present::INT * 40 + ucp_present::INT * 30 + commerce_present::INT * 30 + has_sample_offers::INT * 10 + has_sample_products::INT * 10) AS score_commerce,
    least(100, verified_payment_surface::INT * 70 + (label = 'machine_payable')::INT * 20 + (payment_surface IS NOT NULL)::INT * 10 + (priced_action_count <> 0)::INT * 10) AS score_payment
  FROM ({RECEIPT_LOG}) r) s
"""
LAST_STATE = f"SELECT domain, arg_max(is_interesting, pos) AS keep, max(pos) AS last_pos FROM ({RECEIPT_LOG}) r GROUP BY domain"
ELIGIBLE = f"""
SELECT s.*, coalesce(l.keep, false) AS detail_eligible FROM ({SCORED}) s LEFT JOIN ({LAST_STATE}) l USING (domain)
"""
CANONICAL = f"""
SELECT * FROM ({ELIGIBLE}) e
QUALIFY row_number() OVER (PARTITION BY domain ORDER BY detail_eligible DESC, verified_payment_surface DESC,
  score_overall DESC, score_payment DESC, score_callable DESC, score_commerce DESC,
  CAST(floor(epoch(ts)) AS BIGINT) DESC, coalesce(rank, 1000000000000) ASC, pos ASC) = 1
"""
SCORE_COLUMNS = "score_overall, score_readable, score_callable, score_commerce, score_payment"


def scored(spark, sf):
    return scoring.with_scores(receipt_rows(spark, sf))


def positives_of(spark, sf):
    return select.positives(receipt_rows(spark, sf).select("domain", "pos", "label", "is_interesting"))


def eligible(spark, sf):
    return publish.mark_eligible(scored(spark, sf), positives_of(spark, sf))


def canonical_rows(spark, sf):
    return publish.canonical(eligible(spark, sf))


def public_rows(spark, sf):
    return canonical_rows(spark, sf).where("detail_eligible")


def ranked_rows(spark, sf):
    return publish.with_list_position(public_rows(spark, sf))


@query("surface_flags", f"SELECT pos, {', '.join(FLAG_PROBE)} FROM ({RECEIPT_LOG}) r")
def surface_flags(spark, sf):
    return scoring.with_surface_flags(receipt_log(spark, sf)).select("pos", *FLAG_PROBE)


def _bigints(*names):
    return [F.col(n).cast("bigint").alias(n) for n in names]


SCORES = ["score_overall", "score_readable", "score_callable", "score_commerce", "score_payment"]


@query("scores", "SELECT pos, " + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in SCORES) + f" FROM ({SCORED}) s")
def scores(spark, sf):
    return scored(spark, sf).select("pos", *_bigints(*SCORES))


@query(
    "positives",
    f"SELECT l.domain, l.last_pos AS pos, r.label FROM ({LAST_STATE}) l JOIN ({RECEIPT_LOG}) r ON r.pos = l.last_pos WHERE l.keep",
)
def positives(spark, sf):
    return positives_of(spark, sf).select("domain", "pos", "label")


@query("detail_eligible", f"SELECT pos, domain, detail_eligible FROM ({ELIGIBLE}) e")
def detail_eligible(spark, sf):
    return eligible(spark, sf).select("pos", "domain", "detail_eligible")


@query("canonical", f"SELECT domain, pos, label, CAST(score_overall AS BIGINT) AS score_overall, detail_eligible FROM ({CANONICAL}) c")
def canonical(spark, sf):
    return canonical_rows(spark, sf).select("domain", "pos", "label", *_bigints("score_overall"), "detail_eligible")


RANKED = f"SELECT *, row_number() OVER (ORDER BY score_overall DESC, domain ASC) AS list_position FROM ({CANONICAL}) c WHERE detail_eligible"


@query("list_position", f"SELECT domain, CAST(score_overall AS BIGINT) AS score_overall, list_position FROM ({RANKED}) r")
def list_position(spark, sf):
    return ranked_rows(spark, sf).select("domain", *_bigints("score_overall", "list_position"))


def _paged(size, column):
    return f"""
SELECT CAST(ceil(list_position / {size}.0) AS BIGINT) AS page, {size} AS page_size, CAST(any_value(total) AS BIGINT) AS total,
       CAST(greatest(1, ceil(any_value(total) / {size}.0)) AS BIGINT) AS total_pages,
       string_agg(domain, ',' ORDER BY list_position) AS {column}
FROM (SELECT *, count(*) OVER () AS total FROM ({RANKED}) r) p GROUP BY 1"""


@query("pages", _paged(30, "results"))
def pages(spark, sf):
    rows = ranked_rows(spark, sf)
    paged = publish.paginate(rows, F.col("domain"), V.PAGE_SIZE, "results")
    return paged.withColumn("results", F.array_join("results", ","))


@query("sitemap_pages", _paged(1000, "domains"))
def sitemap_pages(spark, sf):
    return publish.sitemap_pages(ranked_rows(spark, sf)).withColumn("domains", F.array_join("domains", ","))


@query(
    "export_totals",
    f"""SELECT (SELECT count(*) FROM ({RECEIPT_LOG}) r) AS raw_receipt_count, count(*) AS total_rows,
               count(*) FILTER (WHERE detail_eligible) AS public_receipt_rows,
               strftime(max(ts) FILTER (WHERE detail_eligible), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS latest_crawled_at
        FROM ({CANONICAL}) c""",
)
def export_totals(spark, sf):
    return publish.export_totals(receipt_rows(spark, sf), canonical_rows(spark, sf))


@query("label_counts", f"SELECT label, count(*) AS rows FROM ({CANONICAL}) c WHERE detail_eligible GROUP BY label")
def label_counts(spark, sf):
    return publish.label_counts(public_rows(spark, sf))


def description_sql(offer_count):
    return f"""
concat_ws(' | ', replace(label, '_', ' '), replace(payment_surface, '_', ' '), concat('score ', score_overall),
  CASE WHEN product_count <> 0 THEN concat(product_count, ' products') WHEN {offer_count} <> 0 THEN concat({offer_count}, ' offers')
       WHEN priced_action_count <> 0 THEN concat(priced_action_count, ' priced actions') END,
  CASE WHEN purchase_boundary <> 'unknown' THEN concat('purchase ', replace(purchase_boundary, '_', ' ')) END,
  CASE WHEN control_boundary <> 'unknown' THEN concat('control ', replace(control_boundary, '_', ' ')) END)
"""


@query("description", f"SELECT pos, {description_sql('offer_count')} AS description FROM ({SCORED}) s")
def description(spark, sf):
    return scored(spark, sf).select("pos", scoring.description().alias("description"))


# ---------------------------------------------------------------- evidence

# documents stand for stored bodies of the receipt domains, four to a receipt
EVIDENCE_LOG = """
SELECT doc_id AS pos, CAST(floor(doc_id / 600) AS BIGINT) AS receipt,
       concat('site', CAST(doc_id % 150 AS STRING), '-', CAST(doc_id % 150 % 28 + 1 AS STRING), '.example') AS domain,
       CASE CAST(floor(doc_id / 150) AS BIGINT) % 4 WHEN 0 THEN 'robots_txt' WHEN 1 THEN 'llms_txt' WHEN 2 THEN 'llms_full_txt' ELSE 'sitemap_xml' END AS probe_key,
       CASE WHEN doc_id % 7 < 3 THEN 'invalid' ELSE 'valid' END AS status,
       doc_id % 9 = 0 AS truncated, text
FROM documents
"""
# a domain's evidence is that of its last receipt, and only if that has a valid text of the two that count as a signal
USABLE = f"""
SELECT d.domain, probe_key AS artifact, text, d.receipt AS pos
FROM ({EVIDENCE_LOG}) d JOIN (
  SELECT domain, receipt FROM ({EVIDENCE_LOG}) r GROUP BY domain, receipt
  HAVING max(CASE WHEN probe_key IN ('llms_txt', 'llms_full_txt') AND status = 'valid' THEN 1 ELSE 0 END) = 1) s
  ON d.domain = s.domain AND d.receipt = s.receipt
WHERE d.receipt = (SELECT max(receipt) FROM ({EVIDENCE_LOG}) m WHERE m.domain = d.domain)
  AND probe_key <> 'sitemap_xml' AND status = 'valid' AND NOT truncated AND length(text) > 0
QUALIFY row_number() OVER (PARTITION BY d.domain, probe_key ORDER BY md5(text)) = 1
"""
PREVIEW_SQL = r"""
CASE WHEN trim(regexp_replace({0}, '\s+', ' ', 'g')) = '' THEN NULL
     WHEN length(trim(regexp_replace({0}, '\s+', ' ', 'g'))) <= 180 THEN trim(regexp_replace({0}, '\s+', ' ', 'g'))
     ELSE concat(rtrim(substr(trim(regexp_replace({0}, '\s+', ' ', 'g')), 1, 177)), '...') END
"""
EVIDENCE_ROWS = f"""
SELECT domain, max(octet_length(encode(text))) FILTER (WHERE artifact = 'robots_txt') AS robots_txt_size,
       max(octet_length(encode(text))) FILTER (WHERE artifact = 'llms_txt') AS llms_txt_size,
       max(octet_length(encode(text))) FILTER (WHERE artifact = 'llms_full_txt') AS llms_full_txt_size,
       max(preview) FILTER (WHERE artifact = 'robots_txt') AS robots_txt_preview,
       max(preview) FILTER (WHERE artifact = 'llms_txt') AS llms_txt_preview,
       max(preview) FILTER (WHERE artifact = 'llms_full_txt') AS llms_full_txt_preview
FROM (SELECT *, {PREVIEW_SQL.format('text')} AS preview FROM ({USABLE}) u) v GROUP BY domain
"""


def evidence(spark, sf):
    log = run_sql(spark, sf, EVIDENCE_LOG).withColumn("body", F.encode("text", "UTF-8"))
    return EV.evidence_docs(log, "receipt")


@query("preview", f"SELECT doc_id, {PREVIEW_SQL.format('text')} AS preview FROM documents")
def preview(spark, sf):
    from signpost.functions.text import preview as short

    return table(spark, sf, "documents").select("doc_id", short(F.col("text")).alias("preview"))


@query("evidence_docs", f"SELECT domain, artifact, octet_length(encode(text)) AS bytes, md5(text) AS digest FROM ({USABLE}) u")
def evidence_docs(spark, sf):
    return evidence(spark, sf).select("domain", "artifact", F.octet_length("body").cast("bigint").alias("bytes"), F.md5("body").alias("digest"))


EVIDENCE_NAMES = [f"{a}_{k}" for a in V.EVIDENCE_PROBES for k in ("size", "preview")]


def with_evidence(spark, sf, rows):
    return rows.join(EV.evidence_columns(evidence(spark, sf)), "domain", "left")


@query(
    "evidence_join",
    f"SELECT c.domain, {', '.join(EVIDENCE_NAMES)} FROM ({CANONICAL}) c LEFT JOIN ({EVIDENCE_ROWS}) e USING (domain)",
)
def evidence_join(spark, sf):
    return with_evidence(spark, sf, canonical_rows(spark, sf)).select("domain", *EVIDENCE_NAMES)


KEYED = f"""
SELECT c.*, e.* EXCLUDE (domain), substr(sha1(c.domain), 1, 2) AS p,
  CASE WHEN detail_eligible THEN concat('receipts/v1/', substr(sha1(c.domain), 1, 2), '/', c.domain, '.json') END AS receipt_r2_key,
  CASE WHEN detail_eligible THEN concat('evidence/v1/', substr(sha1(c.domain), 1, 2), '/', c.domain, '/proof.json') END AS evidence_r2_key,
  CASE WHEN detail_eligible AND robots_txt_size IS NOT NULL THEN concat('evidence/v1/', substr(sha1(c.domain), 1, 2), '/', c.domain, '/robots.txt') END AS robots_r2_key,
  CASE WHEN detail_eligible AND llms_txt_size IS NOT NULL THEN concat('evidence/v1/', substr(sha1(c.domain), 1, 2), '/', c.domain, '/llms.txt') END AS llms_r2_key,
  CASE WHEN detail_eligible AND llms_full_txt_size IS NOT NULL AND (label IN ('machine_payable', 'callable_surface') OR coalesce(rank <= 10000, false) OR llms_full_txt_size <= 32768)
       THEN concat('evidence/v1/', substr(sha1(c.domain), 1, 2), '/', c.domain, '/llms-full.txt') END AS llms_full_r2_key
FROM ({CANONICAL}) c LEFT JOIN ({EVIDENCE_ROWS}) e USING (domain)
"""


@query("storage_keys", f"SELECT domain, {', '.join(publish.KEYS)} FROM ({KEYED}) k")
def storage_keys(spark, sf):
    return publish.storage_keys(with_evidence(spark, sf, canonical_rows(spark, sf))).select("domain", *publish.KEYS)


def index_rows(spark, sf):
    """Canonical rows from JSON log lines, with storage keys: the whole export up to the index."""
    values = publish.index_values(receipt_log(spark, sf))
    marked = publish.mark_eligible(values, positives_of(spark, sf))
    return publish.storage_keys(with_evidence(spark, sf, publish.canonical(marked)))


_INDEX_SQL = ", ".join(
    ["domain", "domain AS canonical_domain", "CAST(rank AS BIGINT) AS rank", "label", "concat('Site ', domain) AS title",
     "CAST(NULL AS VARCHAR) AS favicon_url", "CAST(NULL AS VARCHAR) AS og_image_url",
     "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS crawled_at", "concat('[\"', label, '\",\"crawl_basics\"]') AS tags_json"]
    + [f"CAST({c} AS BIGINT) AS {c}" for c in SCORES]
    + ["purchase_boundary", "control_boundary", "payment_surface"]
    + [f"CAST({c} AS BIGINT) AS {c}" for c in ["crypto_only", "verified_payment_surface", *FLAG_PROBE]]
    + ["CAST(product_count AS BIGINT) AS product_count"]
    + [f"CAST(NULL AS BIGINT) AS {c}" for c in ["variant_count", "priced_variant_count", "currency_count"]]
    + ["CASE WHEN coalesce(offer_count, 0) <> 0 THEN CAST(offer_count AS BIGINT) ELSE 7 END AS offer_count",
       "CAST(NULL AS BIGINT) AS priced_offer_count", "CAST(priced_action_count AS BIGINT) AS priced_action_count",
       "concat('[\"card\",\"', label, '\"]') AS payment_rail_hints_json"]
    + [f"'[]' AS {c}" for c in publish.LIST_FIELDS if c != "payment_rail_hints_json"]
    + publish.KEYS
)


@query("site_index", f"SELECT {_INDEX_SQL} FROM ({KEYED}) k")
def site_index(spark, sf):
    rows = publish.site_index(index_rows(spark, sf))
    return rows.select(*[F.col(f.name).cast("bigint") if f.dataType.simpleString() == "int" else F.col(f.name) for f in rows.schema])


OFFERS_SQL = "(CASE WHEN coalesce(offer_count, 0) <> 0 THEN offer_count ELSE 7 END)"


@query(
    "site_detail",
    f"""SELECT domain, receipt_r2_key, concat('https://', domain) AS site_url, concat(label, ',crawl_basics') AS tags, CAST(score_overall AS BIGINT) AS score_overall, purchase_boundary,
        openapi_present, crypto_only, CAST({OFFERS_SQL} AS BIGINT) AS offer_count, CAST(NULL AS DOUBLE) AS min_price, payment_surface, concat('card,', label) AS rail_hints,
        CASE WHEN has_sample_offers THEN '[{{"id":"o"}}]' ELSE '[]' END AS offers, concat('d', pos) AS ucp_detail, CASE WHEN ucp_present THEN 'valid' ELSE 'missing' END AS ucp_status,
        robots_r2_key, {description_sql(OFFERS_SQL)} AS description FROM ({KEYED}) k""",
)
def site_detail(spark, sf):
    d = lambda path: F.col(f"detail.{path}")
    return publish.site_detail(index_rows(spark, sf)).select(
        "domain", "receipt_r2_key", d("site_url"), F.array_join(d("tags"), ",").alias("tags"), d("scores.score_overall").cast("bigint").alias("score_overall"), d("boundaries.purchase_boundary"),
        d("flags.openapi_present"), d("flags.crypto_only"), d("counts.offer_count"), d("counts.min_price"), d("payment.payment_surface"), F.array_join(d("payment.rail_hints"), ",").alias("rail_hints"),
        F.to_json(d("samples.offers")).alias("offers"), d("probe_summary.ucp.detail").alias("ucp_detail"), d("probe_summary.ucp.status").alias("ucp_status"), d("evidence.robots_r2_key"), d("description"),
    )


@query(
    "proof",
    f"""SELECT evidence_r2_key AS key, purchase_boundary, control_boundary, payment_surface, label AS second_rail, CASE WHEN x402_present THEN '200' ELSE '404' END AS x402_status
        FROM ({KEYED}) k WHERE detail_eligible""",
)
def proof(spark, sf):
    """The payload is the published JSON text; the check reads members back from it."""
    p = lambda path: F.get_json_object("payload", f"$.{path}")
    return publish.proofs(publish.site_detail(index_rows(spark, sf))).select(
        "key", p("boundaries.purchase_boundary").alias("purchase_boundary"), p("boundaries.control_boundary").alias("control_boundary"), p("payment.payment_surface").alias("payment_surface"),
        p("payment.rail_hints[1]").alias("second_rail"), p("probe_summary.x402.http_status").alias("x402_status"),
    )


def entries(spark, sf):
    return publish.list_entries(publish.with_list_position(index_rows(spark, sf).where("detail_eligible")))


@query(
    "list_entry",
    f"""SELECT domain, domain AS canonical_domain, CAST(rank AS BIGINT) AS rank, list_position, label, concat('Site ', domain) AS title,
        CAST(NULL AS VARCHAR) AS favicon_url, CAST(NULL AS VARCHAR) AS og_image_url,
        {description_sql('(CASE WHEN coalesce(offer_count, 0) <> 0 THEN offer_count ELSE 7 END)')} AS description,
        concat('https://', domain) AS site_url, robots_txt_preview AS robots, coalesce(llms_txt_preview, llms_full_txt_preview) AS llms,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS crawled_at, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in SCORES)},
        payment_surface, purchase_boundary, control_boundary, crypto_only, verified_payment_surface,
        '' AS payment_provider_hints, concat('card,', label) AS payment_rail_hints, concat(label, ',crawl_basics') AS tags
        FROM (SELECT *, row_number() OVER (ORDER BY score_overall DESC, domain ASC) AS list_position FROM ({KEYED}) k WHERE detail_eligible) q""",
)
def list_entry(spark, sf):
    rows = entries(spark, sf)
    texts = {c: F.array_join(c, ",") for c in ["payment_provider_hints", "payment_rail_hints", "tags"]}
    return rows.withColumns({**texts, **{c: F.col(c).cast("bigint") for c in [*SCORES, "rank", "list_position"]}})


@query(
    "probe_summary",
    f"""SELECT pos, CASE WHEN openapi_present THEN 'valid' ELSE 'missing' END AS openapi_status,
               CASE WHEN x402_present THEN 200 ELSE 404 END::BIGINT AS x402_http_status,
               concat('d', pos) AS products_detail, CAST(NULL AS VARCHAR) AS cart_status
        FROM ({RECEIPT_LOG}) r""",
)
def probe_summary(spark, sf):
    s = receipt_log(spark, sf).select("pos", scoring.probe_summary().alias("s"))
    return s.select(
        "pos", F.col("s.openapi.status").alias("openapi_status"), F.col("s.x402.http_status").cast("bigint").alias("x402_http_status"),
        F.col("s.products.detail").alias("products_detail"), F.col("s.cart.status").alias("cart_status"),
    )


@query(
    "manifest",
    f"""SELECT 1 AS version, (SELECT count(*) FROM ({RECEIPT_LOG}) r) AS raw_receipt_count, count(*) AS total_rows, count(*) FILTER (WHERE detail_eligible) AS public_receipt_rows,
        strftime(max(ts) FILTER (WHERE detail_eligible), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS latest_crawled_at,
        (SELECT string_agg(concat(label, '=', n), ',' ORDER BY label) FROM (SELECT label, count(*) AS n FROM ({CANONICAL}) c2 WHERE detail_eligible GROUP BY label) l) AS label_counts,
        CAST(greatest(1, ceil(count(*) FILTER (WHERE detail_eligible) / 30.0)) AS BIGINT) AS pages, CAST(greatest(1, ceil(count(*) FILTER (WHERE detail_eligible) / 1000.0)) AS BIGINT) AS sitemaps,
        'top-sites/v1/manifest.json' AS manifest_key FROM ({CANONICAL}) c""",
)
def manifest(spark, sf):
    rows = canonical_rows(spark, sf)
    totals = publish.export_totals(receipt_rows(spark, sf), rows)
    row = publish.manifest(totals, publish.label_counts(rows.where("detail_eligible")), F.lit("2024-01-31T00:00:00+00:00"))
    counts = F.array_join(F.transform(F.map_entries("label_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return row.select(
        F.col("version").cast("bigint").alias("version"), "raw_receipt_count", "total_rows", "public_receipt_rows", "latest_crawled_at", counts.alias("label_counts"),
        F.col("pages.total_pages").alias("pages"), F.col("sitemaps.total_pages").alias("sitemaps"), F.col("paths.manifest").alias("manifest_key"),
    )


# ---------------------------------------------------------------- rerun slice

HINTED = f"""
SELECT r.*, event_hint FROM (SELECT *, pos % 31 = 0 AS event_hint FROM ({RECEIPT_LOG}) r0) r
"""
RERUN_RULE = """
CASE WHEN label IN ('catalog_surface', 'callable_surface', 'rate_limited') THEN 'label'
     WHEN (label IN ('catalog_surface', 'offer_surface', 'machine_payable') OR ucp_present OR products_present
           OR product_count > 40 OR has_sample_offers OR payment_surface IS NOT NULL) AND (rank IS NULL OR rank <= 120) THEN 'hints' END
"""


def hint_rows(spark, sf):
    """The columns of `rerun.log_hints`, from the flat receipt adapter."""
    rows = run_sql(spark, sf, RECEIPT_LOG)
    zero, no = F.lit(0), F.lit(False)
    return rows.select(
        "pos", "domain", "label", "rank", (F.col("ucp_present") | F.col("products_present")).alias("has_catalog_probe"),
        F.when(F.col("product_count") > 40, F.col("product_count")).otherwise(0).alias("product_count"),
        zero.alias("priced_variant_count"), zero.alias("checkout_url_count"), zero.alias("commerce_priced_offer_count"),
        no.alias("has_payment_rail_hints"), no.alias("has_ucp_capability_names"),
        F.col("has_sample_offers"), F.col("payment_surface").isNotNull().alias("has_payment_surface"),
    )


@query("rerun_predicate", f"SELECT pos, domain, {RERUN_RULE} AS branch FROM ({RECEIPT_LOG}) r")
def rerun_predicate(spark, sf):
    return hint_rows(spark, sf).select("pos", "domain", rerun.rerun_branch(max_rank=120).alias("branch"))


RERUN_FIRST = f"SELECT domain, arg_min(branch, pos) AS branch FROM (SELECT pos, domain, {RERUN_RULE} AS branch FROM ({RECEIPT_LOG}) r) b WHERE branch IS NOT NULL GROUP BY domain"


@query("rerun_counts", f"SELECT branch, count(*) AS domains FROM ({RERUN_FIRST}) f GROUP BY branch")
def rerun_counts(spark, sf):
    return rerun.rerun_counts(rerun.selected_domains(hint_rows(spark, sf), max_rank=120))


# customers stand for the list: several rows may name one domain of the log
SLICE_LIST = """
SELECT CAST(c_custkey AS BIGINT) AS row_index, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey AS INT) END AS rank,
       concat('site', CAST(c_custkey % 160 AS STRING), '-', CAST(c_custkey % 5 + 1 AS STRING), '.example') AS domain
FROM customer
"""


@query(
    "rerun_slice",
    f"""SELECT min(row_index) AS row_index, arg_min(coalesce(rank, -1), row_index)::BIGINT AS rank_or_minus_one, domain
        FROM ({SLICE_LIST}) l WHERE domain IN (SELECT domain FROM ({RERUN_FIRST}) f) GROUP BY domain ORDER BY row_index LIMIT 200""",
)
def rerun_slice(spark, sf):
    chosen = rerun.selected_domains(hint_rows(spark, sf), max_rank=120)
    rows = rerun.rerun_slice(run_sql(spark, sf, SLICE_LIST), chosen, limit=200)
    return rows.select("row_index", F.coalesce("rank", F.lit(-1)).cast("bigint").alias("rank_or_minus_one"), "domain")


# ---------------------------------------------------------------- outcome log figures

OUTCOMES = f"SELECT *, {STATUS_OF_FETCH} AS status FROM ({FETCH_LOG}) f"
RETRY_SECONDS = "CASE WHEN http_status = 429 THEN CASE pos % 5 WHEN 0 THEN 120 WHEN 3 THEN pos % 50 END END"


def outcome_rows(spark, sf):
    return run_sql(spark, sf, f"SELECT *, CAST({RETRY_SECONDS} AS INT) AS retry_after_seconds FROM ({OUTCOMES}) o")


# fixed values, written out
INTERESTING_LIST = """'llms_txt', 'llms_full_txt', 'well_known_commerce', 'well_known_ucp', 'well_known_agent_json', 'well_known_agents_json', 'well_known_agent_card',
  'root_agent_json', 'openapi_json', 'api_openapi_json', 'payment_probe', 'x402_json', 'x402_well_known', 'remote_x402', 'products_json', 'api_products'"""


@query(
    "interesting",
    f"""SELECT domain, attempt, coalesce(string_agg(DISTINCT probe_key, ',' ORDER BY probe_key) FILTER (WHERE status = 'valid' AND probe_key IN ({INTERESTING_LIST})), '') AS interesting_keys,
               coalesce(bool_or(status = 'valid' AND probe_key IN ({INTERESTING_LIST})), false) AS is_interesting
        FROM ({OUTCOMES}) o GROUP BY domain, attempt""",
)
def interesting(spark, sf):
    rows = select.interesting(outcome_rows(spark, sf), ["domain", "attempt"])
    return rows.select("domain", F.col("attempt"), F.array_join("interesting_keys", ",").alias("interesting_keys"), "is_interesting")


COUNTED = f"""
SELECT domain, attempt, count(*) FILTER (WHERE status = 'valid') AS valid_count,
       count(*) FILTER (WHERE status = 'rate_limited') AS rate_limited_count,
       count(*) FILTER (WHERE status = 'valid' AND probe_key NOT IN ('homepage', 'robots_txt', 'sitemap_xml')) AS valid_surface_count,
       min(CASE WHEN status = 'rate_limited' THEN {RETRY_SECONDS} END) AS retry_after_seconds
FROM ({OUTCOMES}) o GROUP BY domain, attempt
"""


@query("outcome_counts", f"SELECT domain, attempt, valid_count, rate_limited_count, valid_surface_count FROM ({COUNTED}) c")
def outcome_counts(spark, sf):
    return select.outcome_counts(outcome_rows(spark, sf), ["domain", "attempt"])


@query(
    "rate_limit_summary",
    f"""WITH l AS (SELECT domain, attempt, probe_key, CAST({RETRY_SECONDS} AS BIGINT) AS s,
               list_position(['robots_txt', 'sitemap_xml', 'llms_txt', 'homepage', 'well_known_commerce', 'openapi_json', 'x402_json', 'products_json'], probe_key) AS o
          FROM ({OUTCOMES}) x WHERE status = 'rate_limited')
        SELECT k.domain, k.attempt, CAST(n AS BIGINT) AS rate_limited_probe_count, rate_limited_probe_keys, retry_after_seconds, retry_after_values
        FROM (SELECT domain, attempt, sum(c) AS n, string_agg(probe_key, ',' ORDER BY o) AS rate_limited_probe_keys, min(m) AS retry_after_seconds
              FROM (SELECT domain, attempt, probe_key, o, count(*) AS c, min(s) AS m FROM l GROUP BY ALL) g GROUP BY domain, attempt) k
        LEFT JOIN (SELECT domain, attempt, array_to_string(list(DISTINCT s ORDER BY s)[1:8], ',') AS retry_after_values FROM l WHERE s IS NOT NULL GROUP BY domain, attempt) v
        ON v.domain = k.domain AND v.attempt = k.attempt""",
)
def rate_limit_summary(spark, sf):
    rows = select.rate_limit_summary(outcome_rows(spark, sf), ["domain", "attempt"])
    return rows.select(
        "domain", "attempt", F.col("rate_limited_probe_count").cast("bigint").alias("rate_limited_probe_count"),
        F.array_join("rate_limited_probe_keys", ",").alias("rate_limited_probe_keys"),
        F.col("retry_after_seconds").cast("bigint").alias("retry_after_seconds"),
        F.array_join(F.col("retry_after_values").cast("array<string>"), ",").alias("retry_after_values"),
    )


# receipts of the fetch log: the label depends on the counts so that every retry outcome occurs
ATTEMPTS = f"""
SELECT domain, attempt, valid_count, rate_limited_count, CAST(retry_after_seconds AS INT) AS retry_after_seconds,
       CASE WHEN rate_limited_count >= 3 AND attempt = 1 THEN 'rate_limited' WHEN valid_surface_count >= 9 THEN 'catalog_surface'
            WHEN rate_limited_count >= 3 THEN 'rate_limited' ELSE 'ai_readable' END AS label,
       rate_limited_count % 2 = 0 AS verified_payment_surface
FROM ({COUNTED}) c
"""
BEST_ATTEMPT = f"""
SELECT * FROM ({ATTEMPTS}) a QUALIFY row_number() OVER (PARTITION BY domain ORDER BY
  CASE label WHEN 'rate_limited' THEN 3 WHEN 'ai_readable' THEN 4 ELSE 5 END DESC, verified_payment_surface DESC,
  valid_count DESC, rate_limited_count ASC, attempt ASC) = 1
"""


def attempt_rows(spark, sf):
    sql = ATTEMPTS.replace("FILTER (WHERE", "FILTER(WHERE")
    return run_sql(spark, sf, sql)


@query("best_attempt", f"SELECT domain, attempt, label, valid_count, rate_limited_count FROM ({BEST_ATTEMPT}) b")
def best_attempt(spark, sf):
    return select.best_attempt(attempt_rows(spark, sf)).select("domain", "attempt", "label", "valid_count", "rate_limited_count")


@query(
    "retry_summary",
    f"""WITH a AS ({ATTEMPTS}), f AS (SELECT domain, arg_min(label, attempt) AS initial_label, arg_min(rate_limited_count, attempt) AS initial_rate_limited_count,
               count(*) AS attempt_count FROM a GROUP BY domain),
             d AS (SELECT a.domain, sum(greatest(4.0, coalesce(least(retry_after_seconds, 8), 0))) AS w FROM a
                   JOIN (SELECT domain, max(attempt) AS m FROM a GROUP BY domain) x ON x.domain = a.domain AND a.attempt < x.m GROUP BY a.domain)
        SELECT f.domain, attempt_count > 1 AS retry_attempted, attempt_count, initial_label, b.label AS final_label,
               initial_label = 'rate_limited' AND b.label <> 'rate_limited' AS recovered, CAST(coalesce(w, 0) AS DOUBLE) AS delay_seconds,
               initial_rate_limited_count, b.rate_limited_count AS final_rate_limited_count
        FROM f JOIN ({BEST_ATTEMPT}) b ON b.domain = f.domain LEFT JOIN d ON d.domain = f.domain""",
)
def retry_summary(spark, sf):
    return select.retry_summary(attempt_rows(spark, sf))


@query(
    "retry_plan",
    f"""SELECT domain, rate_limited_count,
               least(3.0, 0.75 + (greatest(rate_limited_count, 1) - 1) * 0.5 + (list_sum(list_transform(string_split(domain, ''), lambda x: ascii(x))) % 250) / 1000.0)::DOUBLE AS backoff_seconds,
               greatest(4.0, coalesce(least(retry_after_seconds, 8), 0))::DOUBLE AS delay_seconds, 9.5::DOUBLE AS timeout_seconds
        FROM ({ATTEMPTS}) a WHERE label = 'rate_limited' AND rate_limited_count > 0""",
)
def retry_plan(spark, sf):
    return select.retry_plan(attempt_rows(spark, sf))


@query(
    "run_counters",
    f"""SELECT 'completed' AS counter, count(*) AS n FROM ({ATTEMPTS}) a
        UNION ALL SELECT 'found', count(*) FROM (SELECT domain, attempt FROM ({OUTCOMES}) o WHERE status = 'valid' AND probe_key IN ({INTERESTING_LIST}) GROUP BY ALL) i
        UNION ALL SELECT concat('label:', label), count(*) FROM ({ATTEMPTS}) a GROUP BY 1
        UNION ALL SELECT concat('probe:', probe_key, ':', status), count(*) FROM (SELECT DISTINCT domain, attempt, probe_key, status FROM ({OUTCOMES}) o) x GROUP BY 1""",
)
def run_counters(spark, sf):
    rows = outcome_rows(spark, sf)
    found = select.interesting(rows, ["domain", "attempt"])
    listed = rows.groupBy("domain", "attempt").agg(F.collect_set(F.struct("probe_key", "status")).alias("outcomes"))
    receipts = attempt_rows(spark, sf).select("domain", "attempt", "label").join(found, ["domain", "attempt"]).join(listed, ["domain", "attempt"])
    return counters.run_counters(receipts)
