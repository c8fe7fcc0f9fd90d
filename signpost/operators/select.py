"""Choosing receipts: attempts, positives, interesting signals, retry figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signpost import values as V
from signpost.sources.fetches import lookup


def label_priority(label: Column) -> Column:
    return F.coalesce(lookup(V.LABEL_PRIORITY, label), F.lit(-1))


def outcome_counts(outcomes: DataFrame, by: list[str]) -> DataFrame:
    """Valid, rate-limited and valid-surface outcomes per receipt."""
    valid = F.col("status") == "valid"
    return outcomes.groupBy(*by).agg(
        F.count_if(valid).alias("valid_count"),
        F.count_if(F.col("status") == "rate_limited").alias("rate_limited_count"),
        F.count_if(valid & ~F.col("probe_key").isin(*V.NON_SURFACE_PROBES)).alias("valid_surface_count"),
    )


def attempt_key() -> Column:
    """Larger is better; the earlier attempt wins a tie."""
    return F.struct(
        label_priority(F.col("label")).alias("label"),
        F.coalesce(F.col("verified_payment_surface").cast("int"), F.lit(0)).alias("verified"),
        F.col("valid_count"),
        (-F.col("rate_limited_count")).alias("limited"),
        (-F.col("attempt")).alias("earlier"),
    )


def best_attempt(receipts: DataFrame) -> DataFrame:
    kept = [c for c in receipts.columns if c != "domain"]
    return receipts.groupBy("domain").agg(F.max_by(F.struct(*kept), attempt_key()).alias("best")).select("domain", "best.*")


def settled_attempts(receipts: DataFrame, base_delay: float = 4.0) -> DataFrame:
    """The best attempt of every domain; where there were retries, its aggregates say what they did.

    `aggregates` is still a struct. One aggregate settles the choice and the retry figures.
    """
    kept = [c for c in receipts.columns if c != "domain"]
    grouped = receipts.groupBy("domain").agg(F.max_by(F.struct(*kept), attempt_key()).alias("best"), *_retry_aggregates(base_delay))
    figures = _retry_figures()
    several = F.col("attempt_count") > 1
    extra = [F.when(several, c).alias(f"rate_limit_retry_{n}") for n, c in figures.items()]
    return grouped.select("domain", "best.*", F.struct(*extra).alias("_retry")).withColumn("aggregates", F.struct("aggregates.*", "_retry.*")).drop("_retry")


def interesting_keys(valid_keys: Column) -> Column:
    return F.array_sort(F.array_intersect(valid_keys, F.array(*[F.lit(k) for k in V.INTERESTING_PROBES])))


def interesting(outcomes: DataFrame, by: list[str]) -> DataFrame:
    """Per receipt: the sorted interesting probe keys that are valid, and whether there is any."""
    hit = (F.col("status") == "valid") & F.col("probe_key").isin(*V.INTERESTING_PROBES)
    keys = outcomes.groupBy(*by).agg(F.array_sort(F.collect_set(F.when(hit, F.col("probe_key")))).alias("interesting_keys"))
    return keys.withColumn("is_interesting", F.size("interesting_keys") > 0)


def positives(receipts: DataFrame, interesting_column: str = "is_interesting", order: str = "pos") -> DataFrame:
    """Domains whose last receipt in append order has a signal, with that receipt."""
    kept = [c for c in receipts.columns if c != "domain"]
    last = receipts.groupBy("domain").agg(F.max_by(F.struct(*kept), order).alias("last"))
    return last.select("domain", "last.*").where(interesting_column)


def byte_sum(name: Column) -> Column:
    """Sum of the UTF-8 bytes of a name, read from its hexadecimal form."""
    digits = F.hex(F.encode(name, "UTF-8"))
    starts = F.sequence(F.lit(1), F.length(digits) - 1, F.lit(2))
    total = F.aggregate(
        starts, F.lit(0).cast("bigint"), lambda acc, i: acc + F.conv(F.substring(digits, i, F.lit(2)), 16, 10).cast("bigint")
    )
    return F.when(F.length(name) > 0, total).otherwise(F.lit(0).cast("bigint"))


def backoff_seconds(domain: Column, hits: Column) -> Column:
    jitter = (byte_sum(domain) % 250) / F.lit(1000.0)
    return F.least(F.lit(3.0), F.lit(0.75) + (F.greatest(hits, F.lit(1)) - 1) * F.lit(0.5) + jitter)


def retry_delay(base_delay: float, retry_after: Column) -> Column:
    return F.greatest(F.lit(max(base_delay, 0.0)), F.coalesce(F.least(retry_after, F.lit(8)).cast("double"), F.lit(0.0)))


def slow_timeout(timeout: float) -> float:
    return max(timeout, timeout * 1.5 + 2.0)


def retry_plan(receipts: DataFrame, base_delay: float = 4.0, timeout: float = 5.0) -> DataFrame:
    """Back-off, delay and time limit of the slow second pass, for rate-limited receipts only."""
    limited = receipts.where((F.col("label") == "rate_limited") & (F.col("rate_limited_count") > 0))
    return limited.select(
        "domain",
        "rate_limited_count",
        backoff_seconds(F.col("domain"), F.col("rate_limited_count")).alias("backoff_seconds"),
        retry_delay(base_delay, F.col("retry_after_seconds")).alias("delay_seconds"),
        F.lit(slow_timeout(timeout)).alias("timeout_seconds"),
    )


def _retry_aggregates(base_delay: float) -> list[Column]:
    """The delay of a pass follows from the receipt before it, so every attempt but the last adds one."""
    pick = F.struct("label", "rate_limited_count")
    delay = retry_delay(base_delay, F.col("retry_after_seconds"))
    return [
        F.min_by(pick, "attempt").alias("initial"), F.max_by(pick, attempt_key()).alias("final"), F.count(F.lit(1)).alias("attempt_count"),
        F.sum(delay).alias("all_delays"), F.max_by(delay, "attempt").alias("last_delay"),
    ]


def _retry_figures() -> dict[str, Column]:
    waited = F.greatest(F.col("all_delays") - F.col("last_delay"), F.lit(0.0))
    return {
        "attempted": F.col("attempt_count") > 1,
        "attempt_count": F.col("attempt_count"),
        "initial_label": F.col("initial.label"),
        "final_label": F.col("final.label"),
        "recovered": (F.col("initial.label") == "rate_limited") & (F.col("final.label") != "rate_limited"),
        "delay_seconds": F.round(waited, 3),
        "initial_rate_limited_probe_count": F.col("initial.rate_limited_count"),
        "final_rate_limited_probe_count": F.col("final.rate_limited_count"),
    }


def retry_summary(receipts: DataFrame, base_delay: float = 4.0) -> DataFrame:
    """What the retries of a domain did. Attempt 1 is the first pass; the best attempt is final."""
    f = _retry_figures()
    return receipts.groupBy("domain").agg(*_retry_aggregates(base_delay)).select(
        "domain", f["attempted"].alias("retry_attempted"), "attempt_count", f["initial_label"].alias("initial_label"), f["final_label"].alias("final_label"),
        f["recovered"].alias("recovered"), f["delay_seconds"].alias("delay_seconds"),
        f["initial_rate_limited_probe_count"].alias("initial_rate_limited_count"), f["final_rate_limited_probe_count"].alias("final_rate_limited_count"))


def rate_limit_summary(outcomes: DataFrame, by: list[str]) -> DataFrame:
    """Count, first 16 keys in probe order, least Retry-After and its first 8 distinct values.

    The key list is bounded by the probe catalogue; the value list is cut before it is collected.
    """
    order = lookup({k: i for i, k in enumerate(V.PROBE_ORDER)}, F.col("probe_key"))
    limited = outcomes.where("status = 'rate_limited'").withColumn("key_order", order)
    keys = limited.groupBy(*by, "probe_key", "key_order").agg(
        F.count(F.lit(1)).alias("n"), F.min("retry_after_seconds").alias("least")
    )
    summary = keys.groupBy(*by).agg(
        F.sum("n").alias("rate_limited_probe_count"),
        F.array_sort(F.collect_list(F.struct("key_order", "probe_key"))).alias("ordered"),
        F.min("least").alias("retry_after_seconds"),
    )
    values = smallest_values(limited.where("retry_after_seconds IS NOT NULL"), by, "retry_after_seconds", 8)
    return summary.join(values, by, "left").select(
        *by,
        "rate_limited_probe_count",
        F.slice(F.transform("ordered", lambda x: x["probe_key"]), 1, 16).alias("rate_limited_probe_keys"),
        "retry_after_seconds",
        F.col("smallest").alias("retry_after_values"),
    )


def smallest_values(df: DataFrame, by: list[str], column: str, k: int) -> DataFrame:
    """The `k` smallest distinct values per group; a group's state never exceeds `k` rows per task."""
    distinct = df.select(*by, column).distinct()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(column))
    top = distinct.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return top.groupBy(*by).agg(F.array_sort(F.collect_list(column)).alias("smallest"))
