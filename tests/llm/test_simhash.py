import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from signpost.llm.graph import components
from signpost.llm.simhash import fingerprint, fingerprint_links, near_duplicates


def brute_fingerprint(text, width=4):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=4):
    """prints: list of (doc_id, fingerprint)."""
    root = {d: d for d, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(prints):
        for b, y in prints[:i]:
            if (x ^ y).bit_count() <= bits:
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: find(d) for d, _ in prints}


@pytest.mark.parametrize("text", [None, "", " \t\r\n", "One", "a b c", "a b c d", "É É\x0bÜ x y z", "ÀB " * 500, "x y Z w q 𝄞 𝄞"])
def test_fingerprint_equals_brute_force(text):
    got = fingerprint(None if text is None else text.encode(), 4)
    assert got & (1 << 64) - 1 == brute_fingerprint(text)


def test_components_of_chains_and_stars(spark):
    edges = [(5, 5)] + [(i + 1, i) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (200, 201)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    random.seed(2)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)]
    parent = {i: i for e in edges for i in e if e[0] != e[1]}
    for _ in range(300):
        for a, b in edges:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == parent


@pytest.mark.parametrize("limit", [1000, 3])
def test_links_keep_every_component(spark, limit):
    random.seed(5)
    centres = [random.getrandbits(64) for _ in range(12)]
    prints = sorted({c ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 3))) for c in centres for _ in range(25)})
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    want = brute_components(list(enumerate(prints)))
    links = fingerprint_links(spark.createDataFrame(rows, "id long, fp long"), list_limit=limit)
    got = {i: i for i, _ in rows} | {r.id: r.root for r in components(links).collect()}
    assert got == want
    value = dict(enumerate(prints))
    assert all((value[r.a] ^ value[r.b]).bit_count() <= 4 for r in links.collect())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    want = brute_components(prints)
    got = near_duplicates(docs).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(d, f"{p:016x}", want[d]) for d, p in prints}
    assert len(got) == len(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "same words here"), (4, "SAME words\there"), (4, "SAME words\there"), (None, "same words here"), (None, "alone entirely else"), (9, "w " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit(1), "key": F.lit("x"), "id": F.lit(0)})
    got = sorted((str(r.doc_id), str(r.component_id)) for r in near_duplicates(docs).collect())
    assert got == sorted([("1", "1"), ("2", "1"), ("3", "3"), ("4", "3"), ("4", "3"), ("None", "3"), ("None", "None"), ("9", "9")])
    assert near_duplicates(docs.limit(0)).collect() == []


def test_majority_is_strict():
    assert fingerprint(b"a b c d e", 4) & (1 << 64) - 1 == brute_fingerprint("a b c d e")
    assert np.uint64(brute_fingerprint("q")) == np.uint64(xxhash.xxh64_intdigest(b"q", 42))
