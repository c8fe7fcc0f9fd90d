from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from signpost.llm.mixing import emit, mix, source_targets
from tests.llm.common import same_as_sql

SCHEMA = "doc_id long, source string, text string"


def brute_targets(sizes):
    """Share, stop at three times the size, reshare, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped, target = sum(sizes.values()), {}, {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        target = {s: Fraction(left * weight[s], sum(weight[x] for x in free)) for s in free}
        over = {s: 3 * sizes[s] for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return {s: float(v) for s, v in (capped | target).items()}
        capped |= over


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 20, "c": 30}, {"a": 1000, "b": 1, "c": 1, "d": 500}, {None: 7, "b": 0, "Z": 3}, {"x": 0}, {"é": 9, "z": 1, "a": 90, None: 1},
    {f"s{i}": (i * 37) % 101 for i in range(40)},
])
def test_targets(spark, sizes):
    got = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = brute_targets(sizes)
    assert {r.source: pytest.approx(r.target) for r in got} == want and len(got) == len(sizes)


def test_query_equals_sql(spark):
    same_as_sql(spark, "/root/testdata/sf0.001", "op10_mixing")
    same_as_sql(spark, "/root/testdata/sf0.01", "op10_mixing")


def test_taken_comes_near_the_target(spark):
    rows = mix(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size
    assert all(abs(taken[s] - t) <= 0.02 * t + 1 for s, t in target.items())


def test_reruns_and_partitionings_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = sorted(mix(docs).select("doc_id", "taken").collect())
    assert sorted(mix(docs.repartition(13, F.rand(3))).select("doc_id", "taken").collect()) == one


def test_odd_rows_and_emission(spark):
    rows = [(1, "a", None), (2, "a", ""), (3, None, "x y"), (3, None, "x y"), (None, "b", "one two three"), (4, "b", "w " * 50_000)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"size": F.lit("s"), "copies": F.lit(9), "_key": F.lit(0), "_doc": F.lit(1)})
    mixed = mix(docs)
    got = mixed.collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter([(1, 0), (2, 0), (3, 2), (3, 2), (None, 3), (4, 50_000)])
    copied = emit(docs, mixed)
    assert copied.columns == docs.columns
    wanted = Counter()
    for r in got:
        wanted[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in copied.collect()) == +wanted
    assert mix(docs.limit(0)).collect() == [] and emit(docs.limit(0), mix(docs.limit(0))).collect() == []
