import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions.lists import merge_ordered
from signpost.operators import candidates as C
from signpost.operators import classify, merges, publish, rerun, select
from signpost.operators.scoring import FLAGS


def brute_merge(existing, values, limit):
    out = list(existing)[:limit]
    for v in (x.strip() for x in values):
        if v and v not in out and len(out) < limit:
            out.append(v)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "b", "c", "d"]), unique=True, max_size=4), st.lists(st.sampled_from([" a", "b\t", "", " ", "e", "f", "a"]), max_size=8), st.integers(1, 5))
def test_merge_ordered(spark, existing, values, limit):
    df = spark.createDataFrame([(existing, values)], "e array<string>, v array<string>")
    got = df.select(merge_ordered(F.col("e"), F.col("v"), limit).alias("m")).first().m
    assert got == brute_merge(existing, values, limit)
    again = df.select(merge_ordered(F.array(*[F.lit(x) for x in got]).cast("array<string>"), F.col("v"), limit).alias("m")).first().m
    assert again == brute_merge(got, values, limit)


@pytest.mark.parametrize("parts", [1, 8])
def test_cross_row_merge_with_a_hot_group(spark, parts):
    rows = [("hot", i % 3, i, f" v{i % 40} ") for i in range(3000)] + [("cold", 0, 1, "x")]
    df = spark.createDataFrame(rows, "g string, rank int, pos int, v string").repartition(parts)
    got = {r.g: r.merged for r in merges.ordered_merge(df, ["g"], "v", ["rank", "pos"], 12).collect()}
    ordered = [v.strip() for _, v in sorted(((r, p), v) for g, r, p, v in rows if g == "hot")]
    assert got["hot"] == list(dict.fromkeys(ordered))[:12] and got["cold"] == ["x"]


def receipt(domain, pos, **over):
    row = {"domain": domain, "pos": pos, "detail_eligible": False, "verified_payment_surface": False, "score_overall": 0, "score_payment": 0,
           "score_callable": 0, "score_commerce": 0, "crawled_at": "2024-01-01T00:00:00", "rank": None}
    return {**row, **over}


CANONICAL = ("domain string, pos int, detail_eligible boolean, verified_payment_surface boolean, score_overall int, score_payment int, "
             "score_callable int, score_commerce int, crawled_at string, rank long")


@pytest.mark.parametrize("better", [
    {"detail_eligible": True}, {"verified_payment_surface": True}, {"score_overall": 1}, {"score_payment": 1}, {"score_callable": 1},
    {"score_commerce": 1}, {"crawled_at": "2024-01-01T00:00:01Z"}, {"rank": 10**9},
])
def test_canonical_key(spark, better):
    rows = [receipt("d", 1), receipt("d", 2, **better), receipt("d", 3)]
    df = spark.createDataFrame(rows, CANONICAL)
    assert publish.canonical(df).first().pos == 2
    same = spark.createDataFrame([receipt("d", 2), receipt("d", 1), receipt("d", 3, crawled_at="bad")], CANONICAL)
    assert publish.canonical(same.repartition(3)).first().pos == 1


def test_best_attempt_ties(spark):
    schema = "domain string, attempt int, label string, verified_payment_surface boolean, valid_count int, rate_limited_count int"
    rows = [("a", 1, "ai_readable", False, 2, 0), ("a", 2, "ai_readable", False, 2, 0), ("b", 1, "rate_limited", True, 9, 0), ("b", 2, "ai_readable", False, 0, 5),
            ("c", 1, "internal_error", False, 0, 0), ("c", 2, "unreachable", False, 0, 0), ("d", 1, "ai_readable", False, 2, 1), ("d", 2, "ai_readable", False, 2, 0)]
    got = {r.domain: r.attempt for r in select.best_attempt(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": 1, "b": 2, "c": 2, "d": 2}


def test_retry_figures(spark):
    df = spark.createDataFrame([("bücher.example", 3)], "d string, h int")
    got = df.select(select.backoff_seconds(F.col("d"), F.col("h")).alias("b"), select.byte_sum(F.col("d")).alias("s")).first()
    total = sum("bücher.example".encode())
    assert got.s == total and abs(got.b - min(3.0, 0.75 + 1.0 + total % 250 / 1000)) < 1e-9
    assert select.slow_timeout(5.0) == 9.5


@pytest.mark.parametrize("limit,count", [(0, 1), (-1, 2), (None, 2), (1, 1), (5, 2)])
def test_rerun_slice_limits(spark, limit, count):
    domains = spark.createDataFrame([(0, None, "x"), (1, 2, "a"), (2, 3, "a"), (3, 4, "b")], "row_index long, rank int, domain string")
    chosen = spark.createDataFrame([("a", "label"), ("b", "hints"), ("zz", "label")], "domain string, branch string")
    rows = sorted(rerun.rerun_slice(domains, chosen, limit).collect(), key=lambda r: r.row_index)
    assert [r.row_index for r in rows] == [1, 3][:count]


@pytest.mark.parametrize("rows,size,pages", [(0, 30, 1), (60, 30, 2), (61, 30, 3), (3, 0, 3)])
def test_pages_cover_each_row_once(spark, rows, size, pages):
    df = spark.range(rows).select((F.col("id") + 1).alias("list_position"), F.concat(F.lit("d"), F.col("id").cast("string")).alias("domain"))
    got = publish.paginate(df, F.col("domain"), size, "domains").orderBy("page").collect()
    assert len(got) == pages and all(p.total == rows and p.total_pages == pages for p in got)
    assert list(itertools.chain(*[p.domains for p in got])) == [f"d{i}" for i in range(rows)]


def test_flags_cover_the_index(spark):
    assert len(publish.INDEX_COLUMNS) == 50 and len(publish.LISTED) == 26 and len(FLAGS) == 11 and len(V.SUMMARY_GROUPS) == 14


def test_candidate_ranking_with_a_hot_group(spark):
    schema = "g string, pos int, url string, title string, amount string, body_kind string, source string, probe_key string"
    rows = [("hot", i, f"https://x/{'buy' if i % 4 == 0 else 'x'}", None, None, None, "openapi", ["openapi_json", "x402_json"][i % 2]) for i in range(2000)]
    rows.append(("cold", 1, "https://x/health", "Search", "5", "object", "x402", "x402_json"))
    got = C.rank_candidates(spark.createDataFrame(rows, schema), ["g"]).collect()
    want = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (-(60 if "buy" in r[2] else 10), ["openapi_json", "x402_json"].index(r[7]), r[1]))
    assert [r.pos for r in sorted((x for x in got if x.g == "hot"), key=lambda x: x.candidate_rank)] == [r[1] for r in want]
    assert [(r.score, r.candidate_rank) for r in got if r.g == "cold"] == [(40 - 20 + 15 + 10 + 6, 1)]


def test_template_parameters(spark):
    df = spark.createDataFrame([("customer_id",), ("address",), ("slug",), ("userId",), ("id",), ("name",)], "p string")
    got = {r.p: r.a for r in df.select("p", C.parameter_aliases(F.col("p")).alias("a")).collect()}
    assert got["customer_id"] == ["customer_id", "customer", "customerid", "id"] and got["id"] == ["id"]
    assert got["userId"] == ["userid", "user_id", "user", "id"] and got["name"] == ["name", "name_id", "nameid", "id"]
    assert got["slug"] == ["slug", "handle", "slug_id", "slugid", "id"] and got["address"][1] == "btc_address"


LABELS = [
    ({"x402_json": {"accept_count": 1}}, "machine_payable"), ({"well_known_commerce": {"priced_offer_count": 1}}, "offer_surface"),
    ({"openapi_json": {"path_count": 1}}, "callable_surface"), ({"products_json": {"product_count": 1}}, "catalog_surface"),
    ({"llms_txt": {"char_count": 1}}, "ai_readable"), ({"robots_txt": "rate_limited"}, "rate_limited"), ({"homepage": "error"}, "unreachable"),
    ({"robots_txt": {"x": 1}, "sitemap_xml": {"x": 1}}, "crawl_basics_only"), ({"homepage": {"title": "t"}}, "no_clear_signal"),
]


def test_label_ladder(spark):
    import json

    rows = []
    for i, (probes, _) in enumerate(LABELS):
        for key, facts in probes.items():
            valid = isinstance(facts, dict)
            rows.append((f"d{i}", key, "valid" if valid else facts, json.dumps(facts) if valid else None, i))
    df = spark.createDataFrame(rows, "domain string, probe_key string, status string, json string, pos int")
    wide = classify.pivot_outcomes(df.withColumn("facts", F.parse_json("json")), ["domain"], ["status", "facts"])
    got = {r.domain: r.label for r in classify.classified(wide).select("domain", "label").collect()}
    assert got == {f"d{i}": label for i, (_, label) in enumerate(LABELS)}
