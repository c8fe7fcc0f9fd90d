import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signpost.llm.queries import QUERIES
from signpost.llm.whitening import _packed, _unpacked, distinct_numbers, fit, scatter, whiten

SCHEMA = "vec_id long, embedding array<float>"


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 130), st.integers(1, 5), st.sampled_from([0, 1, 9, 40, 62]), st.integers(0, 2**32))
def test_scatter_equals_products(rows, size, bits, seed):
    x = np.random.default_rng(seed).integers(-(1 << bits), (1 << bits) + 1, (rows, size))
    sums, products = scatter(x)
    want = x.astype(object)
    assert list(sums) == list(want.sum(axis=0))
    full = want.T @ want
    assert all(products[i, j] == full[i, j] for i in range(size) for j in range(i, size))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(-300, 300), st.integers(-(2**63), 2**63 - 1)), min_size=3, max_size=3), min_size=1, max_size=9))
def test_packing_round_trip(rows):
    packed = _packed(np.array(rows, dtype=np.int64))
    back = sorted(tuple(r) for m in _unpacked(packed) for r in m.tolist())
    assert back == sorted(map(tuple, rows)) and len(set(packed.to_pylist())) == len(set(map(tuple, rows)))


def brute(rows):
    """Distinct whole vectors, their sums and covariance with Python integers."""
    kept = [(i, [int(math.floor(256 * float(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit_list = [list(x) for x in {tuple(x) for _, x in kept}]
    n, size = len(fit_list), len(fit_list[0])
    sums = [sum(x[d] for x in fit_list) for d in range(size)]
    cross = [[sum(x[i] * x[j] for x in fit_list) for j in range(size)] for i in range(size)]
    spread = np.array([[(n * cross[i][j] - sums[i] * sums[j]) / n**2 for j in range(size)] for i in range(size)])
    return kept, fit_list, n, sums, spread


def compare(got, rows):
    kept, fit_list, n, sums, spread = brute(rows)
    size = len(sums)
    values, vectors = np.linalg.eigh(spread)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(4, size)
    assert len(got) == k * len(kept)
    by = {}
    for r in got:
        by.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    for c in range(1, k + 1):
        direction = vectors[:, c - 1] / math.sqrt(values[c - 1])
        first = next(iter(kept))
        want_first = float((np.array(first[1]) - np.array(sums) / n) @ direction)
        sign = 1 if abs(by[c][first[0]][0].whitened - want_first) < 1e-6 * (1 + abs(want_first)) else -1
        for i, x in kept:
            r = by[c][i][0]
            want = sign * float((np.array(x) - np.array(sums) / n) @ direction)
            assert r.whitened == pytest.approx(want, rel=1e-7, abs=1e-7)
            assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
            assert r.explained == pytest.approx(values[c - 1] / np.trace(spread), rel=1e-9)
            assert 0 <= r.identity_error < 1e-9


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(QUERIES["op12_embedding_whitening"](spark, f"/root/testdata/{sf}").collect(), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)] + [(1000 + i, [0.1] * 6) for i in range(200)]  # one vector many times
    rows += [(2001, None), (2002, [1.0, None, 0, 0, 0, 0]), (2003, [float("nan")] * 6), (2004, [float("inf"), 0, 0, 0, 0, 0]), (2005, [-0.0] * 6)]
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", n long, component string")
    compare(whiten(df).collect(), rows)
    again = {(r.vec_id, r.component): (r.deviation, abs(r.whitened)) for r in whiten(df.repartition(9, F.rand(2))).collect()}
    assert all(again[r.vec_id, r.component] == pytest.approx((r.deviation, abs(r.whitened)), rel=1e-9, abs=1e-9) for r in whiten(df).collect())


def test_equal_rows_nulls_and_empty_tables(spark):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert whiten(frame([])).collect() == [] and whiten(frame([(1, None), (2, [])])).collect() == []
    same = whiten(frame([(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.5, 1.0])])).collect()
    assert len(same) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, None, None, None)}
    line = whiten(frame([(i, [float(i), 2.0 * i, 3.0]) for i in range(5)])).collect()
    assert {r.component: r.whitened is None for r in line} == {1: False, 2: True, 3: True}
    assert all(r.explained == pytest.approx(1) for r in line if r.component == 1)
    ragged = whiten(frame([(1, [1.0]), (2, [1.0, 2.0]), (3, []), (4, [3.0, 1.0])])).collect()
    assert len(ragged) == 8 and {r.n for r in ragged} == {4}


def test_very_large_entries(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    rows = whiten(df).collect()
    assert len(rows) == 6 and all(r.deviation is None for r in rows if r.vec_id < 3)
    # beside a spread of 2^126 the second component's is nothing
    assert all((r.whitened is None) == (r.component == 2) for r in rows)
    model = fit(distinct_numbers(df))
    assert model.sums[0] == -1 and model.n == 3
