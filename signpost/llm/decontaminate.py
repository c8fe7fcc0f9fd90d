"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Records are item windows (a fixed number of consecutive item words) and documents; their tokens are
shingles of two words. A window occurs in a document only if all its shingles do, so its necessary
prefix is a single shingle: the rarest one in the whole corpus. Windows whose rarest shingle never
occurs are gone before the second pass. Documents are scanned twice, each time map-side against a
broadcast block of shingles: once to count them, once to meet the prefix shingles. A meeting is
bounded by position and length and verified word by word in the same stage, so no document text is
shuffled and only true occurrences leave the scan. Blocks have a fixed number of rows; a larger
benchmark takes more blocks, with the same result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signpost.llm.rows import whole_row
from signpost.session import cut

WIDTH = 10
BLOCK_ROWS = 100_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of the whole text, A-Z lower-cased; empty for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def word_count(text: Column) -> Column:
    """How many words the whole text has, without lower-casing them; 0 for null."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), _NO_WORD), "")).cast("long")


def shingles(found: Column) -> Column:
    """One hash per word: of it and the word after it, or of the word alone where it is the last."""
    return F.transform(found, lambda w, i: F.xxhash64(w, F.get(found, i + 1)))


def item_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct (item_id, window); an item of fewer words, but not none, is one window."""
    found = items.select("item_id", words(F.col("text")).alias("_words")).filter(F.size("_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_words") - width + 1, F.lit(1)))
    return found.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("_words", i, width))).alias("window")).distinct()


def _blocks(rows: DataFrame, order: str, size: int) -> list[DataFrame]:
    """`rows` in blocks of about `size` rows by hash; small enough to be sent to every task."""
    many = -(-max(rows.count(), 1) // size)
    if many == 1:
        return [rows]
    return [rows.filter(F.pmod(F.xxhash64(order), F.lit(many)) == i) for i in range(many)]


def _tokens(windows: DataFrame) -> DataFrame:
    """(window, at, key): the shingles inside each window; a window of one word has that word alone."""
    own = F.transform(F.col("window"), lambda w, i: F.struct(i.alias("at"), F.xxhash64(w, F.get(F.col("window"), i + 1)).alias("key")))
    inside = F.slice(own, F.lit(1), F.greatest(F.size("window") - 1, F.lit(1)))
    return windows.select("window", F.inline(inside))


def occurrences(docs: DataFrame, windows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(_row columns of `docs`, start, window): each place where a window stands; `docs` has `_words` and `_single` besides."""
    keep = [c for c in docs.columns if c != "_words"]
    tokens = cut(_tokens(windows.select("window").distinct()))
    # a last word has a shingle of its own, so windows of one word need the single words of the texts as well
    lone = not tokens.filter(F.size("window") == 1).isEmpty()
    single = F.transform(F.col("_words"), lambda w: F.xxhash64(w, F.lit(None).cast("string")))

    def placed(columns: list[str]) -> DataFrame:
        pairs = docs.select(*columns, F.posexplode(shingles(F.col("_words"))).alias("pos", "key"))
        return pairs.union(docs.select(*columns, F.posexplode(single).alias("pos", "key"))) if lone else pairs

    keys = cut(tokens.select("key").distinct())
    counts = reduce(DataFrame.union, [
        placed([]).join(F.broadcast(block), "key").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        for block in _blocks(keys, "key", 10 * block_rows)])
    rarest = F.row_number().over(Window.partitionBy("window").orderBy("n", "key", "at"))
    counted = tokens.join(counts, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    prefix = counted.withColumn("_turn", rarest).filter("_turn = 1 AND n > 0")
    prefix = cut(prefix.select("key", "at", "window", F.size("window").alias("_length")))
    start = F.col("pos") - F.col("at")
    fits = (start >= 0) & (start + F.col("_length") <= F.size("_words"))
    # the guard keeps the slice legal where the bounds do not hold
    equal = F.slice("_words", F.greatest(start, F.lit(0)) + 1, F.col("_length")) == F.col("window")
    found = [
        placed([*keep, "_words"]).join(F.broadcast(block), "key").filter(fits & equal).select(*keep, start.alias("start"), "window")
        for block in _blocks(prefix, "window", block_rows)]
    return reduce(DataFrame.union, found).distinct()


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of `docs` (doc_id, text).

    n_hit: words inside any occurrence of a window of `items` (item_id, text). n_items and items_sha256
    are over the items with an occurring window; an item without an id hits words but is not listed.
    Null texts have no words. Rows that agree in doc_id and text have the same result each.
    """
    text_key = F.xxhash64("text", F.lit(1))
    windows = cut(item_windows(items, width))
    read = docs.select("doc_id", text_key.alias("_text"), words(F.col("text")).alias("_words"))
    found = cut(occurrences(read, windows, block_rows))
    by_row = ["doc_id", "_text"]
    spans = F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.size("window")).alias("end"))))
    # spans in order of start: each adds what lies beyond the furthest end before it
    covered = F.aggregate(
        "_spans", F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["hit"] + F.greatest(s["end"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("hit"), F.greatest(a["end"], s["end"]).alias("end")),
        lambda a: a["hit"])
    hits = found.groupBy(*by_row).agg(spans.alias("_spans")).select(*by_row, covered.alias("n_hit"))
    named = found.join(windows.filter("item_id IS NOT NULL"), "window").select(*by_row, "item_id").distinct()
    listed = named.groupBy(*by_row).agg(
        F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list(F.col("item_id").cast("string"))), ",").alias("_items"))
    hits = hits.withColumnRenamed("doc_id", "_id").withColumnRenamed("_text", "_hash")
    listed = listed.withColumnRenamed("doc_id", "_id2").withColumnRenamed("_text", "_hash2")
    rows = docs.select("doc_id", text_key.alias("_text"), word_count(F.col("text")).alias("n_words"))
    joined = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left")
    joined = joined.join(listed, F.col("doc_id").eqNullSafe(F.col("_id2")) & (F.col("_text") == F.col("_hash2")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return joined.select(
        "doc_id", "n_words", n_hit.cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("_items", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows of `docs`, with its columns, in which no item window occurs."""
    text_key = F.xxhash64("text", F.lit(1))
    read = docs.select("doc_id", text_key.alias("_text"), words(F.col("text")).alias("_words"))
    found = occurrences(read, cut(item_windows(items, width)), block_rows)
    found = cut(found.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash")).distinct())
    if found.count() <= 10 * block_rows:  # two numbers a row; beyond that Spark joins as it sees fit
        found = F.broadcast(found)
    held = docs.select(whole_row(docs), F.col("doc_id").alias("_key"), text_key.alias("_text"))
    same = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
    return held.join(found, same, "left_anti").select("_doc.*")
