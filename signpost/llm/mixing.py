"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, target / size of the source. Documents
stand in an order drawn by hash, expected copies are prefix-summed within the source, one offset is
added, and a document is emitted once per integer boundary its interval crosses. The random number of
a source gives a ring of OFFSETS equally spaced offsets; the one whose words come nearest to the target
is used, which matters where one document is a large part of its source.

Nothing of a hot source meets in one task: rows are range-partitioned by (source, drawn order), each
partition numbers its own rows, and only one row per partition and source is prefix-summed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signpost.llm.rows import whole_row
from signpost.session import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
OFFSETS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from one row per source (source, source_size).

    Sources in code point order, null last, weigh `weights`, repeating, and share the sum of all sizes;
    a target stops at `most` times its source's size, and the rest is shared by weight among the others.
    Sources fill up in order of cap / weight, so two running sums over that order give all targets. The
    windows hold one row per source, not per document.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    weighed = sizes.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), turn))
    fill = Window.orderBy(F.col("source_size") / F.col("_weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    cap = F.col("source_size") * most
    spread = (
        weighed.withColumn("_left", F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("_open", F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0)))
        .withColumn("_full", F.col("_left") * F.col("_weight") >= cap * F.col("_open"))
        .withColumn("_rank", F.row_number().over(fill))
    )
    # the sources that fill up come first; what is left at the first that does not is shared by all after it
    at = F.min(F.when(~F.col("_full"), F.struct("_rank", "_left", "_open"))).over(whole)
    target = F.when(F.col("_full"), cap.cast("double")).otherwise(at["_left"] * F.col("_weight") / at["_open"])
    return spread.withColumn("target", target).select("source", "source_size", "target")


def _copies(rank: Column, rate: Column, offset: Column) -> Column:
    """Integer boundaries in ((rank - 1) * rate + offset, rank * rate + offset]."""
    return F.floor(rank * rate + offset) - F.floor((rank - 1) * rate + offset)


def mix(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of `docs` (doc_id, source, text).

    size: words of the whole text, 0 for null. A null source is a source of its own. Repeated rows are
    sampled one by one. Sources without words have target 0 and give nothing. Same rows and seed, same
    result, however the rows are partitioned.
    """
    drawn = F.substring(F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 16)
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), drawn.alias("_drawn"))
    rows = cut(sized.repartitionByRange("source", "_drawn", "doc_id", "size").withColumn("_part", F.spark_partition_id()))
    parts = rows.groupBy("source", "_part").agg(F.count(F.lit(1)).alias("_rows"), F.sum("size").alias("_words"))
    sources = parts.groupBy("source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sources, weights, most).withColumn(
        "_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed), key)), 1, 8), 16, 10).cast("double") / float(1 << 32)
    targets = targets.withColumn("_draw", draw)
    ahead = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)))
    plan = parts.join(targets, parts["source"].eqNullSafe(targets["source"])).select(
        parts["source"], "_part", "_before", "source_size", "target", "_rate", "_draw")
    inside = Window.partitionBy("source", "_part").orderBy("_drawn", "doc_id", "size")
    numbered = rows.withColumn("_row", F.row_number().over(inside))
    same = numbered["source"].eqNullSafe(plan["source"]) & (numbered["_part"] == plan["_part"])
    ranked = cut(numbered.join(plan, same).select(
        "doc_id", numbered["source"], "size", (F.col("_before") + F.col("_row")).alias("_rank"), "source_size", "target", "_rate", "_draw"))
    offsets = [F.col("_draw") / OFFSETS + i / OFFSETS for i in range(OFFSETS)]
    sums = [F.sum(_copies(F.col("_rank"), F.col("_rate"), o) * F.col("size")).alias(f"_sum{i}") for i, o in enumerate(offsets)]
    totals = ranked.groupBy("source", "target", "_draw").agg(*sums)
    tried = F.array(*[F.struct(F.abs(F.col(f"_sum{i}") - F.col("target")).alias("miss"), o.alias("offset")) for i, o in enumerate(offsets)])
    best = totals.select(F.col("source").alias("_source"), F.array_min(tried)["offset"].alias("_offset"))
    copies = _copies(F.col("_rank"), F.col("_rate"), F.col("_offset"))
    return ranked.join(best, ranked["source"].eqNullSafe(best["_source"])).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def emit(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of `docs`, each as often as `mixed` (of the same rows) says, with the columns of `docs`.

    Rows that agree in doc_id, source and size share the copies of their key evenly.
    """
    key = F.to_json(F.struct(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("n")))
    wanted = mixed.groupBy(key.alias("_key")).agg(F.sum("copies").alias("_all"), F.count(F.lit(1)).alias("_same")).filter("_all > 0")
    held = docs.select(whole_row(docs), "doc_id", "source", word_count(F.col("text")).alias("size"))
    held = held.select("_doc", key.alias("_key")).join(wanted, "_key")
    turn = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    own = F.floor(F.col("_all") / F.col("_same")) + F.when(turn <= F.col("_all") % F.col("_same"), 1).otherwise(0)
    again = held.withColumn("_own", own.cast("int")).filter("_own > 0")
    return again.select("_doc", F.explode(F.array_repeat(F.lit(0), F.col("_own"))).alias("_copy")).select("_doc.*")
