"""Running figures of a crawl."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_counters(receipts: DataFrame) -> DataFrame:
    """(counter, n): completed and found receipts, receipts per label, outcomes per probe and status.

    One pass: each receipt turns into its own few counter names, which combine before the shuffle.
    `found` counts receipts, not domains. `outcomes` is an array of (probe_key, status).
    """
    names = F.concat(
        F.array(F.lit("completed"), F.concat(F.lit("label:"), F.col("label"))),
        F.when(F.col("is_interesting"), F.array(F.lit("found"))).otherwise(F.array().cast("array<string>")),
        F.transform("outcomes", lambda o: F.concat(F.lit("probe:"), o["probe_key"], F.lit(":"), o["status"])),
    )
    return receipts.select(F.explode(names).alias("counter")).groupBy("counter").agg(F.count(F.lit(1)).alias("n"))
