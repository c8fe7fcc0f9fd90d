"""The rerun slice: which domains of a list to crawl again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions import documents as D
from signpost.sources.position import number_sorted
from signpost.sources.receipts import probe_status

HINT_LABELS = ["catalog_surface", "offer_surface", "machine_payable"]
HINT_PROBES = ["well_known_ucp", "cart_json", "products_json", "api_products"]
HINT_COUNTS = ["product_count", "priced_variant_count", "checkout_url_count", "commerce_priced_offer_count"]
HINT_LISTS = ["payment_rail_hints", "ucp_capability_names", "sample_offers"]


def log_hints(receipts: DataFrame) -> DataFrame:
    """Columns the predicate reads, taken from a receipt log."""
    def agg(name: str) -> Column:
        return D.get(F.col("aggregates"), name)

    def filled_list(v: Column) -> Column:
        return F.coalesce(F.size(D.as_list(v)) > 0, F.lit(False))

    valid = reduce(lambda a, b: a | b, [F.coalesce(probe_status(k) == "valid", F.lit(False)) for k in HINT_PROBES])
    return receipts.select(
        "pos",
        "domain",
        "label",
        F.when(D.kind(F.col("rank")) == "BIGINT", D.as_whole(F.col("rank"))).alias("rank"),
        valid.alias("has_catalog_probe"),
        *[F.coalesce(D.as_whole(agg(c)), F.lit(0)).alias(c) for c in HINT_COUNTS],
        *[filled_list(agg(c)).alias(f"has_{c}") for c in HINT_LISTS],
        D.truthy(agg("payment_surface")).alias("has_payment_surface"),
    ).where("domain <> ''")


def strong_hints() -> Column:
    tests = [F.col("label").isin(*HINT_LABELS), F.col("has_catalog_probe"), F.col("has_payment_surface")]
    tests += [F.col(c) > 0 for c in HINT_COUNTS] + [F.col(f"has_{c}") for c in HINT_LISTS]
    return reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])


def rerun_branch(labels: list[str] | None = None, hints: bool = True, max_rank: int | None = None) -> Column:
    """`label`, `hints` or null: the rule a receipt is selected by. The rank cap binds hints only."""
    wanted = [x.strip() for x in labels or [] if x.strip()] or V.RERUN_LABELS
    within = F.lit(True) if max_rank is None else F.coalesce(F.col("rank") <= max_rank, F.lit(True))
    branch = F.when(F.col("label").isin(*wanted), F.lit("label"))
    return branch.when(strong_hints() & within, F.lit("hints")) if hints else branch


def selected_domains(receipts: DataFrame, **rules) -> DataFrame:
    """(domain, branch): each selected domain under the rule of its first matching receipt."""
    matched = receipts.withColumn("branch", rerun_branch(**rules)).where("branch IS NOT NULL")
    return matched.groupBy("domain").agg(F.min_by("branch", "pos").alias("branch"))


def rerun_counts(selected: DataFrame) -> DataFrame:
    return selected.groupBy("branch").agg(F.count(F.lit(1)).alias("domains"))


def rerun_slice(domains: DataFrame, selected: DataFrame, limit: int | None = None) -> DataFrame:
    """Selected domains in list order, first row per domain.

    The limit is tested after a row is written: 0 still gives one row, a negative one does not bind.
    """
    hits = domains.join(selected.select("domain"), "domain", "left_semi")
    first = hits.groupBy("domain").agg(F.min_by(F.struct("row_index", "rank"), "row_index").alias("first"))
    rows = first.select(F.col("first.row_index").alias("row_index"), F.col("first.rank").alias("rank"), "domain")
    if limit is None or limit < 0:
        return rows
    # list positions differ, so numbering them cuts the list without gathering it in one task
    placed = number_sorted(rows, [F.col("row_index").asc()], "_place")
    return placed.where(F.col("_place") <= max(limit, 1)).drop("_place")
