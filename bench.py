"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driver_queries import load  # noqa: E402
from signpost.session import local_session  # noqa: E402

HEADLINE = [
    "scores", "canonical", "list_position", "pages", "export_totals", "rerun_counts", "run_counters", "rate_limit_summary",
    "crawl_outcomes", "complete_outcomes", "soft404", "homepage_facts", "llms_facts", "payment_hints", "preview",
    "price_normalize", "product_facts", "openapi_facts", "x402_facts", "label", "candidate_rank", "ordered_merge",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    queries, _ = load()
    spark.range(1000).count()
    times = {}
    for name in HEADLINE:
        start = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
