"""Global positions without pulling the rows through one task.

Rows are numbered inside their own split or partition; only one tiny row per split goes through
the prefix sum, whatever the size of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signpost.session import cut


def offsets(counts: DataFrame, order: list[str]) -> DataFrame:
    """Rows before each split. `counts` has one row per split, never one per data row."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("rows_before", F.coalesce(F.sum("split_rows").over(before), F.lit(0)))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines (blank ones kept) with the split they came from: (line, file, block, seq).

    (file, block, seq) orders the lines the way the files hold them: that is all a first-wins or
    last-wins rule needs, and it costs no extra pass.
    """
    return (
        spark.read.text(path)
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
        .withColumn("seq", F.monotonically_increasing_id())
    )


def append_order() -> Column:
    """Order of a line in its log, as one comparable value."""
    return F.struct("file", "block", "seq")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(row_index, line): 0-based line number over all files in name order."""
    rows = read_lines(spark, path)
    splits = rows.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("split_rows"), F.min("seq").alias("first_seq")
    )
    numbered = rows.join(offsets(splits, ["file", "block"]), ["file", "block"])
    return numbered.select((F.col("rows_before") + F.col("seq") - F.col("first_seq")).alias("row_index"), "line")


def number_sorted(df: DataFrame, order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """`df` with a 1-based global position by `order`.

    A range shuffle sorts the rows. Its result is written to the shared folder once, because a
    second run of the range sampling could cut the ranges elsewhere; then each partition adds the
    rows of the partitions before it. `order` must be total.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    fixed = cut(ranged.sortWithinPartitions(*order))
    tagged = fixed.withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id())
    parts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("split_rows"), F.min("_seq").alias("_first"))
    joined = tagged.join(offsets(parts, ["_part"]), "_part")
    position = F.col("rows_before") + F.col("_seq") - F.col("_first") + 1
    return joined.withColumn(name, position).drop("_part", "_seq", "_first", "rows_before", "split_rows")
