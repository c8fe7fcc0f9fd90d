"""Connected components of an edge table, entirely as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signpost.session import cut


def _followed(up: DataFrame) -> DataFrame:
    """(id, up) with every pointer followed to the end: pointers lead to smaller ids, and each step doubles their reach."""
    while True:
        next_ = up.select(F.col("id").alias("up"), F.col("up").alias("next"))
        far = cut(up.join(next_, "up").select("id", F.col("next").alias("up"), (F.col("next") < F.col("up")).alias("moved")))
        up = far.select("id", "up")
        if far.filter("moved").isEmpty():
            return up


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id reachable, for every id that stands in an edge (a, b); ids are not null.

    Every node points to its smallest neighbour if that is smaller; pointers are followed to the end and
    the edges are contracted to what they connect then. At least half of the nodes that still have an
    edge go in each round, and the edges inside a dense group go in the first. A node with very many
    edges is reduced map-side; its rows in the joins are split by the adaptive skew join.
    """
    open_ = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    labels = None
    while labels is None or not open_.isEmpty():
        both = open_.union(open_.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = cut(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b")).select("id", F.least("id", "b").alias("up")))
        up = _followed(up)
        ends = [up.select(F.col("id").alias(c), F.col("up").alias(f"{c}_up")) for c in ("a", "b")]
        moved = open_.join(ends[0], "a").join(ends[1], "b").select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b"))
        open_ = cut(moved.filter("a <> b").distinct())
        if labels is None:
            labels = up.select("id", F.col("up").alias("root"))
        else:
            later = up.select(F.col("id").alias("root"), "up")
            labels = cut(labels.join(later, "root", "left").select("id", F.coalesce("up", "root").alias("root")))
    return labels
