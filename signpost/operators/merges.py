"""Bounded merges over rows: ordered-distinct lists, samples, candidates, per-document facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions import documents as D
from signpost.functions.lists import empty_strings, merge_all, merge_ordered, or_empty, sorted_distinct
from signpost.functions.text import blank_to_null, strip


def first_rows(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first `k` rows per group with their `place`.

    The rank limit is applied inside every task before the shuffle, so no task ever gathers a
    whole group.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= k)


def ordered_merge(values: DataFrame, by: list[str], value: str, order: list[str], limit: int) -> DataFrame:
    """(by..., merged): distinct stripped values in order of their first occurrence, at most `limit`.

    `order` is e.g. (source_rank, pos); equal values combine to their first place before ranking.
    """
    clean = values.withColumn("_value", strip(F.col(value))).where("_value <> ''")
    firsts = clean.groupBy(*by, "_value").agg(F.min(F.struct(*order)).alias("_first"))
    top = first_rows(firsts, by, [F.col("_first")], limit)
    listed = top.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("place", "_value"))).alias("_list"))
    return listed.select(*by, F.transform("_list", lambda x: x["_value"]).alias("merged"))


def distinct_items(items: DataFrame, by: list[str], identity: list[str], order: list[str], limit: int) -> DataFrame:
    """One row per distinct item (its first occurrence), the first `limit` per group, with `place`."""
    payload = [c for c in items.columns if c not in by and c not in identity]
    firsts = items.groupBy(*by, *identity).agg(F.min_by(F.struct(*payload), F.struct(*order)).alias("_item"))
    opened = firsts.select(*by, *identity, "_item.*")
    return first_rows(opened, by, [F.col(c) for c in order], limit)


def action_samples(actions: DataFrame, by: list[str], limit: int = 6) -> DataFrame:
    """Sample actions distinct on method, url (or path) and title."""
    keyed = actions.withColumn("target", F.coalesce(blank_to_null(F.col("url")), F.col("path")))
    return distinct_items(keyed, by, ["method", "target", "title"], ["source_rank", "pos"], limit)


def probe_candidates(candidates: DataFrame, by: list[str], limit: int = 6) -> DataFrame:
    """Payment candidates distinct on method and url."""
    return distinct_items(candidates, by, ["method", "url"], ["source_rank", "pos"], limit)


def checkout_candidates(candidates: DataFrame, by: list[str], limit: int = 8) -> DataFrame:
    """Candidates distinct by url; every row without a url is kept."""
    url = blank_to_null(strip(F.col("url")))
    unnamed = F.when(url.isNull(), F.struct("source_rank", "pos"))
    keyed = candidates.withColumns({"url_key": url, "own_key": unnamed})
    return distinct_items(keyed, by, ["url_key", "own_key"], ["source_rank", "pos"], limit).drop("own_key")


def observed_merge(facts: DataFrame, by: list[str]) -> DataFrame:
    """Observed values of all valid documents of a receipt, per fact key, at most 12."""
    return ordered_merge(facts.where("status = 'valid'"), [*by, "fact_key"], "value", ["probe_rank", "pos"], 12)


# ------------------------------------------------------------------ merges inside a receipt row


def fact(outcome: Column, name: str) -> Column:
    return D.get(outcome["facts"], name)


def fact_strings(outcome: Column, name: str) -> Column:
    """A string-list fact of one outcome; empty when missing."""
    return or_empty(F.try_variant_get(outcome["facts"], f"$.{name}", "array<string>"))


def merge_agent_facts(documents: list[Column]) -> Column:
    """Facts of up to three agent documents in fixed order: lists united, scalars first-found."""
    lists = {
        name: merge_all([fact_strings(d, name) for d in documents], 12) for name in V.AGENT_LIST_FACTS
    }
    scalars = {
        name: F.coalesce(*[blank_to_null(D.as_string(fact(d, name))) for d in documents]) for name in V.AGENT_SCALAR_FACTS
    }
    crypto = F.coalesce(*[F.when(D.truthy(fact(d, "crypto_only")), F.lit(True)) for d in documents])
    priced = F.greatest(*[F.coalesce(D.as_whole(fact(d, "priced_action_count")), F.lit(0).cast("bigint")) for d in documents], F.lit(0).cast("bigint"))
    merged = F.struct(
        *[c.alias(n) for n, c in lists.items()],
        *[c.alias(n) for n, c in scalars.items()],
        crypto.alias("crypto_only"),
        F.when(priced > 0, priced).alias("priced_action_count"),
        F.size(lists["public_endpoint_urls"]).alias("public_endpoint_count"),
    )
    return merged


UCP_COUNTS = ["payment_handler_count", "service_count", "capability_count"]
UCP_LISTS = [
    "payment_handler_names", "payment_handler_ids", "payment_endpoint_samples", "capability_names",
    "shopping_mcp_endpoints", "payment_provider_hints", "payment_rail_hints", "payment_endpoint_hosts",
]


def merge_ucp_facts(root: Column, versioned: Column) -> Column:
    """Root document enriched by its versioned one: larger counts, sorted lists, else first truthy.

    Both are structs of UCP facts. Without a versioned document the root stays as it is.
    """
    counts = {n: F.greatest(root[n], versioned[n]) for n in UCP_COUNTS}
    lists = {n: sorted_distinct(F.concat(or_empty(root[n]), or_empty(versioned[n])), 12) for n in UCP_LISTS}
    scalars = {
        n: F.coalesce(blank_to_null(root[n]), versioned[n]) for n in ("ucp_version", "payment_surface", "current_version_url")
    }
    crypto = F.coalesce(root["crypto_only"], F.lit(False)) | F.coalesce(versioned["crypto_only"], F.lit(False))
    merged = F.struct(*[c.alias(n) for n, c in {**counts, **lists, **scalars, "crypto_only": crypto}.items()])
    plain = F.struct(*[root[n].alias(n) for n in [*UCP_COUNTS, *UCP_LISTS, "ucp_version", "payment_surface", "current_version_url", "crypto_only"]])
    return F.when(versioned.isNull(), plain).otherwise(merged)


def enrich_checkout(catalog: Column, found: Column) -> Column:
    """A valid catalogue's checkout facts with those of a second source: max count, at most 6 URLs."""
    more = F.coalesce(found["checkout_url_count"], F.lit(0).cast("bigint"))
    own = F.coalesce(catalog["checkout_url_count"], F.lit(0).cast("bigint"))
    urls = merge_ordered(empty_strings(), F.concat(or_empty(catalog["sample_checkout_urls"]), or_empty(found["sample_checkout_urls"])), 6)
    return F.struct(
        F.greatest(own, more).alias("checkout_url_count"),
        urls.alias("sample_checkout_urls"),
        F.concat(catalog["detail"], F.lit("; enriched with UCP checkout data")).alias("detail"),
    )


def remote_x402_urls(domain: Column, llms: Column, llms_full: Column, agent_url: Column, agent_urls: Column) -> Column:
    """Discovery URLs named by other documents, ordered distinct, without the domain's own two."""
    own = F.array(
        F.concat(F.lit("https://"), domain, F.lit("/.well-known/x402")),
        F.concat(F.lit("https://"), domain, F.lit("/.well-known/x402.json")),
    )
    named = merge_all([llms, llms_full, F.array(agent_url), agent_urls], None)
    return F.filter(named, lambda u: ~F.array_contains(own, u))
