"""Near duplicates by SimHash: positional byte index, count filter, verification.

Two 64-bit fingerprints that differ in at most 4 bits differ in at most 4 of their 8 bytes, so at
least 4 positional bytes are equal. The index lists every distinct fingerprint under 20 triples of
positional bytes, chosen so that any 4 equal positions hold one of the triples; a pair is tallied
where it first meets, kept if it shares at least 4 positional bytes, and verified by its bits. A list
holds one 2**24th of all fingerprints, so the index grows with the corpus, not with its square.

Lists beyond `list_limit` (dense clouds of near copies) are not paired. Their fingerprints meet in a
second index under every value at most 2 bits away: two fingerprints at most 4 bits apart share such a
value, and two that share one are at most 4 bits apart, so a star per value keeps every component whole.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost.llm.graph import components
from signpost.llm.rows import whole_row
from signpost.session import cut, ship_package

BITS = 4
SEED = 42
LIST_LIMIT = 1000
ROWS_SENT = 1_000_000  # keys of two numbers: some 50 MB
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)).reshape(256, 8).astype(np.int64)


def shingle_hashes(text: bytes | None, width: int) -> bytes:
    """The XXH64 digests of all word shingles one after the other; nothing without words. Whole text, repeats counted."""
    joined = b" ".join((text or b"").translate(_LOWER).split())
    if not joined:
        return b""
    spaces = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    digest = xxhash.xxh64_digest
    if len(spaces) < width:
        return digest(joined, SEED)
    starts = [0, *(spaces[: len(spaces) - width + 1] + 1).tolist()]
    ends = [*spaces[width - 1 :].tolist(), len(joined)]
    return b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)])


def fingerprint(text: bytes | None, width: int) -> int:
    """Majority bit of the XXH64 of all word shingles; 0 without words. Whole text, repeats counted."""
    hashes = shingle_hashes(text, width)
    if not hashes:
        return 0
    table = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(table[:, i], minlength=256) @ _BIT_OF_BYTE for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(table)).tobytes(), "big", signed=True)


def _triples() -> list[tuple[int, int, int]]:
    """20 triples of the 8 positions such that every 4 positions hold one (groups of 3, 3 and 2 in a ring)."""
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    chosen = []
    for triple in combinations(range(8), 3):
        size = [sum(group[i] == g for i in triple) for g in range(3)]
        if 3 in size or any(size[g] == 2 and size[(g + 1) % 3] == 1 for g in range(3)):
            chosen.append(triple)
    return chosen


TRIPLES = _triples()


def _byte(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 8 * position).bitwiseAND(F.lit(255))


def _list_keys(value: Column) -> Column:
    keys = [
        F.lit(k << 24).cast("long").bitwiseOR(F.shiftleft(_byte(value, a), 16)).bitwiseOR(F.shiftleft(_byte(value, b), 8))
        .bitwiseOR(_byte(value, c))
        for k, (a, b, c) in enumerate(TRIPLES)
    ]
    return F.array(*keys)


def _linked(left: Column, right: Column, key: Column, bits: int) -> Column:
    """Enough equal positional bytes, few enough differing bits, and `key` is the first list of the pair."""
    differing = left.bitwiseXOR(right)
    equal = [_byte(differing, i) == 0 for i in range(8)]
    tally = sum((e.cast("int") for e in equal[1:]), equal[0].cast("int"))
    first = F.coalesce(*[F.when(equal[a] & equal[b] & equal[c], F.lit(k)) for k, (a, b, c) in enumerate(TRIPLES)])
    return (tally >= 8 - bits) & (F.bit_count(differing) <= bits) & (first == F.shiftright(key, 24).cast("int"))


def fingerprint_links(prints: DataFrame, bits: int = BITS, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Edges (a, b) that connect the `id`s of distinct fingerprints `fp` at most `bits` bits apart."""
    if bits not in (2, 4):
        raise ValueError("bits must be 2 or 4: the index guarantees 4 equal bytes, the second index halves the bits")
    index = prints.select("id", "fp", F.explode(_list_keys(F.col("fp"))).alias("key"))
    sizes = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = cut(index.join(sizes, "key"))
    small = met.filter(F.col("n") <= list_limit)
    left = small.select("key", F.col("id").alias("a"), F.col("fp").alias("fa"))
    right = small.select("key", F.col("id").alias("b"), F.col("fp").alias("fb"))
    rule = (F.col("fa") < F.col("fb")) & _linked(F.col("fa"), F.col("fb"), left["key"], bits)
    pairs = left.join(right, (left["key"] == right["key"]) & rule).select("a", "b")
    crowded = met.filter(F.col("n") > list_limit).select("id", "fp").distinct()
    flips = [0, *(sum(1 << i for i in c) for r in range(1, bits // 2 + 1) for c in combinations(range(64), r))]
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in flips])
    around = crowded.select("id", F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("fp")))).alias("value"))
    lead = around.groupBy("value").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = around.join(lead, "value").filter("id <> b").select(F.col("id").alias("a"), "b").distinct()
    return pairs.union(stars)


def classes(docs: DataFrame, width: int = 4, bits: int = BITS, list_limit: int = LIST_LIMIT) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) for every row of `docs` (doc_id, text)."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("long")
    def prints_of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    rows = cut(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), prints_of(F.col("text").cast("binary")).alias("fp")))
    groups = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("id")))
    roots = components(fingerprint_links(groups.filter("id IS NOT NULL"), bits, list_limit))
    named = groups.join(roots, "id", "left").select("fp", F.coalesce("root", "id").alias("component_id"))
    return rows.join(named, "fp", "left").select("doc_id", "text_hash", "fp", "component_id")


def near_duplicates(docs: DataFrame, width: int = 4, bits: int = BITS, list_limit: int = LIST_LIMIT) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs` (doc_id, text; other columns are ignored).

    component_id is the smallest doc_id reachable over links. Null and wordless texts have fingerprint
    zero, which links like any other. Repeated rows come out as often as they come in. A row with a null
    doc_id links nothing by itself: it gets the component of its fingerprint if a row with an id has
    that fingerprint, else null. Equal texts are one node, so copies cost no pairs.
    """
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return classes(docs, width, bits, list_limit).select("doc_id", hexed, "component_id")


def one_of_each(docs: DataFrame, width: int = 4, bits: int = BITS, list_limit: int = LIST_LIMIT, sent: int = ROWS_SENT) -> DataFrame:
    """The rows of `docs`, with its columns, without all but one row of each group of near duplicates.

    The row with the smallest doc_id stays, of rows that repeat it the one with the smallest text hash.
    Rows without a doc_id that meet no row with one are a group for each fingerprint. Where the rows to
    go are at most `sent`, their keys go to every task; beyond that they are joined.
    """
    rows = classes(docs, width, bits, list_limit)
    lone = F.when(F.col("component_id").isNull(), F.col("fp")).alias("lone")
    return heads_only(docs, rows.select("doc_id", "text_hash", "component_id", lone), ["component_id", "lone"], sent)


def heads_only(docs: DataFrame, rows: DataFrame, group: list[str], sent: int) -> DataFrame:
    """The rows of `docs` that are the head of their group; `rows` has (doc_id, text_hash, *group) for each of them."""
    found = cut(rows.groupBy("doc_id", "text_hash", *group).agg(F.count(F.lit(1)).alias("n")))
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    heads = found.groupBy(*group).agg(F.min(key).alias("head")).select(F.col("head.doc_id").alias("_id"), F.col("head.text_hash").alias("_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    # heads that come once need no mark
    marks = found.join(heads, same, "left").filter("_hash IS NULL OR n > 1").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("_hash").isNotNull().alias("_head"))
    marks = cut(marks)
    if marks.count() <= sent:
        marks = F.broadcast(marks)
    held = docs.select(whole_row(docs), "doc_id", F.xxhash64("text").alias("text_hash")).join(marks, same, "left")
    single = held.filter("_head IS NULL").select("_doc")
    repeated = held.filter("_head").groupBy("doc_id", "text_hash").agg(F.first("_doc").alias("_doc")).select("_doc")
    return single.union(repeated).select("_doc.*")
