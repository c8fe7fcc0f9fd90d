import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from signpost.llm.packing import best_fit, configurations, knapsacks, pack, sequences, weighted_cover
from signpost.llm.queries import QUERIES

FILE = public_tokenizers.path("byte_bpe_50k.json")
SIZE = 1024


def brute_pieces(rows):
    """(doc_id, piece) -> (start, length, crc) by the library itself."""
    encoder, out = Tokenizer.from_file(FILE), defaultdict(list)
    for doc_id, text in rows:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [2]
        head = len(ids) % SIZE
        edges = ([0] if head else []) + list(range(head, len(ids) + 1, SIZE))
        for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            out[doc_id].append((piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    return {k: sorted(v) for k, v in out.items()}


def check(got, rows):
    want, have = brute_pieces(rows), defaultdict(list)
    places = defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in have.items()} == want
    for found in places.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= SIZE
    return len(places), sum(r.length for r in got)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_packs_every_piece(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()]
    used, ids = check(QUERIES["op11_best_fit_packing"](spark, f"/root/testdata/{sf}").collect(), rows)
    assert used <= -(-ids // SIZE) * 1.005 + 2


def best_fit_one_by_one(lengths, size):
    """Best fit, longest first, item by item."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, g in enumerate(gaps) if g >= length]
        if fitting:
            i = min(fitting, key=lambda i: gaps[i])
            gaps[i] -= length
        else:
            gaps.append(size - length)
    return len(gaps)


def fewest(lengths, size):
    """The least number of sequences, by search over all assignments of a few pieces."""
    best = len(lengths)

    def go(i, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if i == len(lengths):
            best = len(gaps)
            return
        for k in {g: k for k, g in enumerate(gaps) if g >= lengths[i]}.values():
            go(i + 1, gaps[:k] + [gaps[k] - lengths[i]] + gaps[k + 1 :])
        go(i + 1, [*gaps, size - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    go(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=10))
def test_configurations_hold_every_piece(lengths):
    counts = np.bincount(lengths, minlength=21).astype(np.int64)
    packed, bound = configurations(counts)
    held = np.zeros(21, dtype=np.int64)
    for content, many in packed.items():
        assert many > 0 and sum(content) <= 20
        for length in content:
            held[length] += many
    least = fewest(lengths, 20)
    assert (held == counts).all() and sum(packed.values()) <= least + 1 and bound <= least + 1e-6


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60))
def test_best_fit_by_groups_equals_best_fit_by_items(lengths):
    counts = np.bincount(lengths, minlength=31).astype(np.int64)
    assert sum(best_fit(counts, {}).values()) == best_fit_one_by_one(lengths, 30)


def test_prices_and_cover():
    random = np.random.default_rng(3)
    lengths, prices = np.array([3, 5, 7]), random.random((2, 3))
    worth, _ = knapsacks(prices, lengths, 17)
    for k in range(2):
        want = max(a * prices[k, 0] + b * prices[k, 1] + c * prices[k, 2] for a in range(6) for b in range(4) for c in range(3) if 3 * a + 5 * b + 7 * c <= 17)
        assert worth[17, k] == pytest.approx(want)
    counts = np.zeros(101, dtype=np.int64)
    counts[[51, 49, 30, 20]] = [1000, 1000, 2000, 2000]  # every sequence can be filled
    times, bound = weighted_cover(counts, rounds=400)
    covered = {length: sum(t * c.count(length) for c, t in times.items()) for length in (51, 49, 30, 20)}
    assert all(covered[length] >= counts[length] * (1 - 1e-9) for length in covered)
    assert bound <= 2000 + 1e-6 and bound == pytest.approx(2000, rel=0.01)
    packed, _ = configurations(counts)
    assert sum(packed.values()) <= 2010


def test_lengths_that_only_fit_in_pairs():
    counts = np.zeros(SIZE + 1, dtype=np.int64)
    counts[300:724] = 1_000_003
    packed, bound = configurations(counts)
    assert sum(packed.values()) <= bound * 1.01


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a<|endoftext|>b"), (None, "no id"), (4, "same"), (4, "same"), (5, "long " * 40_000), (6, " \x85 é\n\n  x")]
    rows += [(100 + i, "word " * (i % 700)) for i in range(400)]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, part string, rank int")
    check(pack(df, FILE).collect(), rows)
    check(pack(df.repartition(9, F.rand(1)), FILE).collect(), rows)
    assert pack(df.limit(0), FILE).collect() == []


def test_sequences(spark):
    rows = [(i, "some words " * (i % 50) + str(i)) for i in range(60)]
    packed = pack(spark.createDataFrame(rows, "doc_id long, text string"), FILE, with_ids=True)
    pieces, found = packed.collect(), {r.sequence_id: r for r in sequences(packed).collect()}
    for r in pieces:
        assert found[r.sequence_id].ids[r.offset : r.offset + r.length] == r.ids and found[r.sequence_id].length <= SIZE
    assert sum(r.length for r in found.values()) == sum(r.length for r in pieces)
