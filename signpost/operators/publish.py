"""Index rows, detail documents, ordered pages, sitemaps and the manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions import documents as D
from signpost.functions.lists import merge_ordered, or_empty, empty_strings
from signpost.functions.text import blank_to_null, strip
from signpost.operators.scoring import FLAGS, description, probe_summary, with_scores, with_surface_flags
from signpost.sources.position import number_sorted
from signpost.sources.sinks import compact_json

PART_SCORES = ["score_overall", "score_readable", "score_callable", "score_commerce", "score_payment"]
LIST_FIELDS = {
    "payment_rail_hints_json": "payment_rail_hints",
    "payment_provider_hints_json": "payment_provider_hints",
    "payment_methods_json": "observed_payment_methods",
    "payment_protocols_json": "observed_payment_protocols",
    "payment_assets_json": "observed_payment_assets",
    "payment_networks_json": "observed_payment_networks",
    "payment_flow_types_json": "observed_payment_flow_types",
    "capability_names_json": "observed_capability_names",
}
COUNTS = ["product_count", "variant_count", "priced_variant_count", "currency_count"]
KEYS = ["receipt_r2_key", "robots_r2_key", "llms_r2_key", "llms_full_r2_key", "evidence_r2_key"]
INDEX_COLUMNS = (
    ["domain", "canonical_domain", "rank", "label", "title", "favicon_url", "og_image_url", "crawled_at", "tags_json"]
    + PART_SCORES
    + ["purchase_boundary", "control_boundary", "payment_surface", "crypto_only", "verified_payment_surface"]
    + FLAGS
    + COUNTS
    + ["offer_count", "priced_offer_count", "priced_action_count"]
    + list(LIST_FIELDS)
    + KEYS
)
LISTED = [
    "domain", "canonical_domain", "rank", "list_position", "label", "title", "favicon_url", "og_image_url",
    "description", "site_url", "robots", "llms", "crawled_at", *PART_SCORES, "payment_surface",
    "purchase_boundary", "control_boundary", "crypto_only", "verified_payment_surface",
    "payment_provider_hints", "payment_rail_hints", "tags",
]


def string_list(v: Column, limit: int = 12) -> Column:
    """Distinct stripped strings of a list value; other items are skipped."""
    strings = F.filter(F.transform(D.as_list(v), D.as_string), lambda x: x.isNotNull())
    return merge_ordered(empty_strings(), or_empty(strings), limit)


def _agg(name: str) -> Column:
    return D.get(F.col("aggregates"), name)


def _either(first: str, second: str) -> Column:
    """`first`, unless it is missing or zero."""
    return D.as_whole(D.first_truthy(_agg(first), _agg(second)))


def epoch(crawled_at: Column) -> Column:
    """Seconds of an ISO timestamp; no zone means UTC, unreadable means 0."""
    zoned = crawled_at.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$") & (F.length(crawled_at) > 10)
    stamp = F.when(zoned, crawled_at).when(F.length(crawled_at) == 10, F.concat(crawled_at, F.lit("T00:00:00Z"))).otherwise(F.concat(crawled_at, F.lit("Z")))
    iso = F.when(crawled_at.rlike(r"^\d{4}-\d{2}-\d{2}"), stamp)
    return F.coalesce(F.unix_seconds(F.try_to_timestamp(iso)), F.lit(0))


def index_values(receipts: DataFrame) -> DataFrame:
    """Typed columns of every receipt: what scores, canonical choice and index rows read."""
    flagged = with_surface_flags(receipts)
    named = flagged.withColumns(
        {
            "domain": F.lower(strip(F.col("domain"))),
            "rank": D.as_whole(F.col("rank")),
            "label": F.coalesce(blank_to_null(F.col("label")), F.lit("no_clear_signal")),
            "title": blank_to_null(D.as_string(F.col("title"))),
            "crawled_at": blank_to_null(D.as_string(F.col("crawled_at"))),
            "tag_list": string_list(F.col("tags")),
            "favicon_url": blank_to_null(D.as_string(_agg("favicon_url"))),
            "og_image_url": blank_to_null(D.as_string(_agg("og_image_url"))),
            "purchase_boundary": F.coalesce(blank_to_null(D.as_string(_agg("purchase_boundary"))), F.lit("unknown")),
            "control_boundary": F.coalesce(blank_to_null(D.as_string(_agg("control_boundary"))), F.lit("unknown")),
            "payment_surface": D.as_string(_agg("payment_surface")),
            "crypto_only": D.truthy(_agg("crypto_only")),
            "verified_payment_surface": D.truthy(_agg("verified_payment_surface")),
            "has_sample_offers": D.truthy(_agg("sample_offers")),
            "has_sample_products": D.truthy(_agg("sample_products")),
            **{c: D.as_whole(_agg(c)) for c in COUNTS},
            "offer_count": _either("commerce_offer_count", "offer_count"),
            "priced_offer_count": _either("commerce_priced_offer_count", "priced_offer_count"),
            "priced_action_count": D.as_whole(_agg("priced_action_count")),
            **{c: string_list(_agg(source)) for c, source in LIST_FIELDS.items()},
        }
    )
    return with_scores(named.where("domain <> ''"))


def mark_eligible(rows: DataFrame, positives: DataFrame) -> DataFrame:
    """`detail_eligible`: the domain is among the positives."""
    wanted = positives.select(F.lower(strip(F.col("domain"))).alias("domain")).distinct()
    hit = wanted.withColumn("_hit", F.lit(True))
    return rows.join(hit, "domain", "left").withColumn("detail_eligible", F.col("_hit").isNotNull()).drop("_hit")


def canonical_order() -> Column:
    """Smallest first: eligible, verified, scores, recency, rank, then append order."""
    down = ["verified_payment_surface", "score_overall", "score_payment", "score_callable", "score_commerce"]
    return F.struct(
        (-F.col("detail_eligible").cast("int")).alias("k0"),
        *[(-F.coalesce(F.col(c).cast("int"), F.lit(0))).alias(f"k{i}") for i, c in enumerate(down, 1)],
        (-epoch(F.col("crawled_at"))).alias("k6"),
        F.coalesce(F.col("rank").cast("bigint"), F.lit(10**12)).alias("k7"),
        F.col("pos"),
    )


def canonical(rows: DataFrame) -> DataFrame:
    """One row per domain. The choice combines inside every task before anything is shuffled."""
    kept = [c for c in rows.columns if c != "domain"]
    best = rows.groupBy("domain").agg(F.min_by(F.struct(*kept), canonical_order()).alias("best"))
    return best.select("domain", "best.*")


def storage_keys(df: DataFrame) -> DataFrame:
    """Publication keys; null unless the domain is eligible and the artifact exists."""
    prefix = F.substring(F.sha1(F.col("domain").cast("binary")), 1, 2)

    def evidence_key(file: str) -> Column:
        return F.concat_ws("/", F.lit(V.EVIDENCE_PREFIX), prefix, F.col("domain"), F.lit(file))

    eligible = F.col("detail_eligible")
    full_wanted = (
        F.col("label").isin("machine_payable", "callable_surface")
        | F.coalesce(F.col("rank") <= V.LLMS_FULL_MAX_RANK, F.lit(False))
        | (F.col("llms_full_txt_size") <= V.LLMS_FULL_MAX_SIZE)
    )
    receipt = F.concat(F.lit(f"{V.RECEIPT_PREFIX}/"), prefix, F.lit("/"), F.col("domain"), F.lit(".json"))
    return df.withColumns(
        {
            "receipt_r2_key": F.when(eligible, receipt),
            "evidence_r2_key": F.when(eligible, evidence_key("proof.json")),
            "robots_r2_key": F.when(eligible & F.col("robots_txt_size").isNotNull(), evidence_key("robots.txt")),
            "llms_r2_key": F.when(eligible & F.col("llms_txt_size").isNotNull(), evidence_key("llms.txt")),
            "llms_full_r2_key": F.when(
                eligible & F.col("llms_full_txt_size").isNotNull() & full_wanted, evidence_key("llms-full.txt")
            ),
        }
    )


def site_index(rows: DataFrame) -> DataFrame:
    """The flat 50-column index row: lists as JSON text, flags as 0/1."""
    ints = {c: F.col(c).cast("int") for c in ["crypto_only", "verified_payment_surface", *FLAGS]}
    texts = {c: compact_json(F.col(c)) for c in LIST_FIELDS}
    return rows.withColumns(
        {"canonical_domain": F.col("domain"), "tags_json": compact_json(F.col("tag_list")), **ints, **texts}
    ).select(*INDEX_COLUMNS)


def site_detail(rows: DataFrame) -> DataFrame:
    """The nested detail document of each row, with its storage keys. Needs the receipt's variants."""

    def sample(name: str) -> Column:
        items = D.list_at(F.col("aggregates"), name)
        usable = F.filter(items, lambda v: D.kind(v).startswith("OBJECT") | (D.kind(v) == "STRING"))
        return F.coalesce(F.slice(usable, 1, 3), F.array().cast("array<variant>"))

    site = F.concat(F.lit("https://"), F.col("domain"))
    named = lambda names: [F.col(n).alias(n) for n in names]
    payment = {
        "payment_surface": F.col("payment_surface"),
        "provider_hints": F.col("payment_provider_hints_json"),
        "rail_hints": F.col("payment_rail_hints_json"),
        "methods": F.col("payment_methods_json"),
        "protocols": F.col("payment_protocols_json"),
        "assets": F.col("payment_assets_json"),
        "networks": F.col("payment_networks_json"),
        "flow_types": F.col("payment_flow_types_json"),
        "requirement_keys": string_list(_agg("observed_payment_requirement_keys")),
        "endpoint_hosts": string_list(_agg("payment_endpoint_hosts")),
    }
    parts = {
        "domain": F.col("domain"),
        "canonical_domain": F.col("domain"),
        "requested_domain": F.col("domain"),
        "rank": F.col("rank"),
        "label": F.col("label"),
        "title": F.col("title"),
        "favicon_url": F.col("favicon_url"),
        "og_image_url": F.col("og_image_url"),
        "site_url": site,
        "homepage_url": site,
        "homepage_final_url": site,
        "crawled_at": F.col("crawled_at"),
        "scanned_at": F.col("crawled_at"),
        "tags": F.col("tag_list"),
        "scores": F.struct(*named(PART_SCORES)),
        "boundaries": F.struct(*named(["purchase_boundary", "control_boundary"])),
        "flags": F.struct(*named([*FLAGS, "verified_payment_surface", "crypto_only"])),
        "counts": F.struct(
            *named([*COUNTS, "offer_count", "priced_offer_count", "priced_action_count"]),
            D.as_double(_agg("min_price")).alias("min_price"),
            D.as_double(_agg("max_price")).alias("max_price"),
        ),
        "payment": F.struct(*[c.alias(n) for n, c in payment.items()]),
        "capabilities": F.col("capability_names_json"),
        "samples": F.struct(
            sample("sample_products").alias("products"),
            sample("sample_offers").alias("offers"),
            sample("sample_actions").alias("actions"),
        ),
        "probe_summary": probe_summary(),
        "evidence": F.struct(*named(KEYS)),
        "source": F.lit("top_site_receipt"),
        "description": description(),
    }
    return rows.select("domain", "receipt_r2_key", "evidence_r2_key", F.struct(*[c.alias(n) for n, c in parts.items()]).alias("detail"))


def list_entries(rows: DataFrame) -> DataFrame:
    """The 26 fields shown per site in a list page. Needs the index values, previews and positions."""
    return rows.withColumns(
        {
            "canonical_domain": F.col("domain"),
            "title": F.coalesce("title", "domain"),
            "description": description(),
            "site_url": F.concat(F.lit("https://"), F.col("domain")),
            "robots": F.col("robots_txt_preview"),
            "llms": F.coalesce("llms_txt_preview", "llms_full_txt_preview"),
            "payment_provider_hints": F.col("payment_provider_hints_json"),
            "payment_rail_hints": F.col("payment_rail_hints_json"),
            "tags": F.col("tag_list"),
        }
    ).select(*LISTED)


def public_order() -> list[Column]:
    return [F.col("score_overall").desc(), F.col("domain").asc()]


def with_list_position(rows: DataFrame) -> DataFrame:
    return number_sorted(rows, public_order(), "list_position")


def page_of(position: Column, page_size: int) -> Column:
    return F.ceil(position / F.lit(max(1, page_size))).cast("bigint")


def one_row(df: DataFrame) -> Column:
    """The columns of a one-row aggregate as a struct column for other frames."""
    return df.select(F.struct(*df.columns)).scalar()


def paginate(rows: DataFrame, item: Column, page_size: int, name: str) -> DataFrame:
    """(page, page_size, total, total_pages, <name>): items of a page in list order.

    A page never holds more than `page_size` items, so the list per group is bounded. No rows at
    all give one empty page.
    """
    size = max(1, page_size)
    pages = (
        rows.select(page_of(F.col("list_position"), size).alias("page"), F.col("list_position"), item.alias("item"))
        .groupBy("page")
        .agg(F.array_sort(F.collect_list(F.struct("list_position", "item"))).alias("items"))
        .withColumn(name, F.transform("items", lambda x: x["item"]))
        .drop("items")
    )
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    first = total.where("total = 0").select(F.lit(1).cast("bigint").alias("page"))
    empty = first.withColumn(name, F.array().cast(pages.schema[name].dataType))
    return pages.unionByName(empty).withColumn("total", total.scalar()).select(
        "page",
        F.lit(size).cast("bigint").alias("page_size"),
        "total",
        F.greatest(F.lit(1), F.ceil(F.col("total") / size)).cast("bigint").alias("total_pages"),
        name,
    )


def sitemap_pages(rows: DataFrame, page_size: int = V.SITEMAP_PAGE_SIZE) -> DataFrame:
    return paginate(rows, F.col("domain"), page_size, "domains")


def list_pages(entries: DataFrame, page_size: int = V.PAGE_SIZE) -> DataFrame:
    return paginate(entries, F.struct(*[F.col(c) for c in LISTED]), page_size, "results")


def page_document(pages: DataFrame, kind: str, prefix: str, items: str) -> DataFrame:
    """Pages as (kind, key, payload) documents."""
    pagination = F.struct(
        F.col("page"), F.col("page_size").alias("pageSize"), F.col("total"), F.col("total_pages").alias("totalPages")
    ).alias("pagination")
    members = [pagination, F.col(items).alias(items)]
    if items == "results":
        members.append(F.lit("score_overall_desc").alias("sort"))
    key = F.concat(F.lit(f"{prefix}/"), F.format_string("%06d", F.col("page")), F.lit(".json"))
    return pages.select(F.lit(kind).alias("kind"), key.alias("key"), compact_json(F.struct(*members)).alias("payload"))


def label_counts(public_rows: DataFrame) -> DataFrame:
    return public_rows.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


def export_totals(rows: DataFrame, canonical_rows: DataFrame) -> DataFrame:
    """Raw, canonical and public counts and the last crawl time (as text) in one row."""
    public = F.col("detail_eligible")
    chosen = canonical_rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(public).alias("public_receipt_rows"),
        F.max(F.when(public, F.col("crawled_at"))).alias("latest_crawled_at"),
    )
    raw = rows.agg(F.count(F.lit(1)).alias("raw_receipt_count"))
    return raw.withColumn("c", one_row(chosen)).select("raw_receipt_count", "c.*")


def manifest(totals: DataFrame, labels: DataFrame, generated_at: Column, page_size: int = V.PAGE_SIZE) -> DataFrame:
    """The export manifest as one row. Labels are a closed set of ten, so their list is bounded."""
    by_label = labels.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "rows")))).alias("label_counts"))

    def paging(size: int, prefix: str) -> Column:
        pages = F.greatest(F.lit(1), F.ceil(F.col("public_receipt_rows") / size)).cast("bigint")
        return F.struct(
            F.lit(size).alias("page_size"), F.lit(prefix).alias("path_prefix"),
            F.col("public_receipt_rows").alias("total"), pages.alias("total_pages"),
        )

    paths = {
        "manifest": f"{V.PUBLIC_PREFIX}/manifest.json",
        "page_prefix": f"{V.PUBLIC_PREFIX}/pages",
        "receipt_prefix": V.RECEIPT_PREFIX,
        "evidence_prefix": V.EVIDENCE_PREFIX,
        "sitemap_prefix": V.SITEMAP_PREFIX,
        "latest_manifest": "manifests/v1/latest.json",
    }
    return totals.withColumn("label_counts", by_label.scalar()).select(
        F.lit(1).alias("version"),
        F.lit("v1").alias("export_version"),
        generated_at.alias("generated_at"),
        F.lit("score_overall_desc").alias("sort"),
        "raw_receipt_count", "total_rows", "public_receipt_rows", "latest_crawled_at", "label_counts",
        paging(max(1, page_size), f"{V.PUBLIC_PREFIX}/pages").alias("pages"),
        paging(V.SITEMAP_PAGE_SIZE, V.SITEMAP_PREFIX).alias("sitemaps"),
        F.struct(*[F.lit(v).alias(k) for k, v in paths.items()]).alias("paths"),
    )


def latest_pointer(manifest_row: DataFrame) -> DataFrame:
    return manifest_row.select(
        "version", "export_version", "generated_at",
        F.col("paths.manifest").alias("top_sites_manifest"), F.col("paths.latest_manifest").alias("manifest"),
        "total_rows", "public_receipt_rows",
    )


def proofs(details: DataFrame) -> DataFrame:
    """(key, payload) of the proof document of every public row."""
    members = ["boundaries", "payment", "samples", "probe_summary"]
    payload = compact_json(F.struct(*[F.col(f"detail.{m}").alias(m) for m in members]))
    return details.where("evidence_r2_key IS NOT NULL").select(F.col("evidence_r2_key").alias("key"), payload.alias("payload"))


def evidence_copies(rows: DataFrame, evidence: DataFrame) -> DataFrame:
    """(key, body): stored bodies under the keys of the public rows."""
    keys = {"robots_txt": "robots_r2_key", "llms_txt": "llms_r2_key", "llms_full_txt": "llms_full_r2_key"}
    wanted = rows.select(
        "domain",
        F.explode(F.array(*[F.struct(F.lit(a).alias("artifact"), F.col(k).alias("key")) for a, k in keys.items()])).alias("w"),
    ).select("domain", "w.artifact", "w.key").where("key IS NOT NULL")
    return evidence.join(wanted, ["domain", "artifact"]).select("key", "body")
