"""Evidence documents: the stored text bodies of a domain's last receipt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions.text import preview


def evidence_docs(outcomes: DataFrame, order: str = "pos") -> DataFrame:
    """(domain, artifact, body) of the valid, whole, non-empty text bodies of each domain's last receipt.

    `order` places the receipt a row belongs to. A later receipt replaces all evidence of the one before,
    and leaves none if it has no signal. The choice runs on narrow columns; a body joins its winner once.
    """
    valid = F.col("status") == "valid"
    signal = F.max(F.coalesce(valid & F.col("probe_key").isin(*V.INTERESTING_PROBES), F.lit(False)))
    states = outcomes.groupBy("domain", order).agg(signal.alias("_signal"))
    kept = states.groupBy("domain").agg(F.max(F.struct(order, "_signal")).alias("_last")).where("_last._signal")
    last = kept.select("domain", F.col(f"_last.{order}").alias(order))
    usable = outcomes.where(
        F.col("probe_key").isin(*V.EVIDENCE_PROBES) & valid
        & ~F.coalesce(F.col("truncated"), F.lit(False)) & (F.octet_length("body") > 0)
    ).select("domain", order, F.col("probe_key").alias("artifact"), F.md5("body").alias("_digest"), "body")
    chosen = usable.drop("body").join(last, ["domain", order]).groupBy("domain", "artifact", order).agg(F.min("_digest").alias("_digest"))
    bodies = usable.join(chosen, ["domain", "artifact", order, "_digest"], "left_semi")
    return bodies.dropDuplicates(["domain", "artifact"]).select("domain", "artifact", "body")


def evidence_columns(evidence: DataFrame) -> DataFrame:
    """One row per domain: size and preview of each artifact.

    A body that is no valid UTF-8 has a size but no preview.
    """
    text = F.col("body").cast("string")
    shown = F.when(F.is_valid_utf8(text), preview(text))
    narrow = evidence.select("domain", "artifact", F.octet_length("body").cast("bigint").alias("size"), shown.alias("preview"))
    aggs = []
    for artifact in V.EVIDENCE_PROBES:
        here = F.col("artifact") == artifact
        aggs.append(F.max(F.when(here, F.col("size"))).alias(f"{artifact}_size"))
        aggs.append(F.max(F.when(here, F.col("preview"))).alias(f"{artifact}_preview"))
    return narrow.groupBy("domain").agg(*aggs)
