import random

import pytest
from pyspark.sql import functions as F

from signpost.llm.url_filters import RULES, cascade, judge_urls, listed_keys
from tests.llm.common import same_as_sql


def brute(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(r), v, r) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    if fits:
        _, verdict, rule = max(fits)
        return host, path, rule, verdict
    labels = host.split(".")
    keys = {".".join(labels[i:]) for i in range(len(labels))} if host else set()
    return host, path, None, "block" if listed & (keys | {k + path for k in keys}) else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.ORG/es/x?y", "https://a.example.org/en/19#z", "x://org/", "x://org", "http://b.com/fr/1", "http://b.com/de/1?q",
    "http://bad.net/p", "http://www.BAD.net?x", "http://notbad.net/", "http://ok.net/listed/page", "http://sub.ok.net/listed/page#f", "http://ok.net/listed/pages", "a://b://bad.net/",
    "http://ÀÉ.net/é", "http://bad.net.:80/", "http://u@bad.net/", "http://" + "l." * 300 + "net/" + "p" * 5000, "http://bad.net/p", "http://one.two.bad.net/a\nb",
]
LISTED = {"bad.net", "ok.net/listed/page", "never.asked"}


@pytest.mark.parametrize("max_bits", [1 << 31, 0])
def test_verdicts_equal_brute_force(spark, max_bits):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(None, "http://bad.net")], "page_id long, url string").withColumns({"host": F.lit(1), "key": F.lit("k"), "_listed": F.lit(0)})
    listed = spark.createDataFrame([(k,) for k in LISTED], "key string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, listed, max_bits=max_bits).collect()}
    assert got == {i: brute(u, LISTED) for i, u in enumerate(URLS)} | {None: brute("http://bad.net", LISTED)}
    assert judge_urls(pages.limit(0), listed, max_bits=max_bits).collect() == []
    assert all(r.listed_key is None for r in judge_urls(pages, listed.limit(0), max_bits=max_bits).collect())


def test_cascade_is_exact_over_its_universe(spark):
    random.seed(1)
    keys = [f"k{i}" for i in range(20_000)]
    listed = set(random.sample(keys, 3000))
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    levels = cascade(spark.createDataFrame([(k,) for k in [*listed, "outside"]], "key string"), universe)
    assert len(levels) > 2 and sum(level.bits for level in levels) < 20 * len(listed)
    asked = universe.select(F.array("key").alias("keys")).select("keys", listed_keys(F.col("keys"), levels).alias("on"))
    assert {r.keys[0] for r in asked.collect() if r.on} == listed


def test_query_equals_sql(spark):
    for sf in ("0.001", "0.01", "0.1"):
        same_as_sql(spark, f"/root/testdata/sf{sf}", "op1_url_filters")
