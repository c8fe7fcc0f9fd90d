"""Surface flags, scores and the one-line description of a receipt."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions.lists import let
from signpost.functions.text import blank_to_null, strip

FLAGS = list(V.SURFACE_GROUPS)


def best_outcome(keys: list[str], probes: str = "probes", fall_back: bool = True) -> Column:
    """First valid outcome of `keys`; with `fall_back` else the first one present.

    `probes` is a struct column with one outcome per probe key. Keys no probe produces are skipped.
    """
    known = [F.col(f"{probes}.{k}") for k in keys if k in V.PROBE_ORDER]
    valid = [F.when(o["status"] == "valid", o) for o in known]
    return F.coalesce(*valid, *(known if fall_back else []))


def valid_in(keys: list[str], probes: str = "probes") -> Column:
    tests = [F.coalesce(F.col(f"{probes}.{k}.status") == "valid", F.lit(False)) for k in keys if k in V.PROBE_ORDER]
    return reduce(lambda a, b: a | b, tests)


def with_surface_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({name: valid_in(keys) for name, keys in V.SURFACE_GROUPS.items()})


def _weighted(weights: dict[str, int]) -> Column:
    points = [F.when(F.col(c), F.lit(w)).otherwise(0) for c, w in weights.items()]
    return F.least(F.lit(100), reduce(lambda a, b: a + b, points))


def with_scores(df: DataFrame) -> DataFrame:
    """Four capped part scores and the half-even rounded overall score."""
    payment = F.least(
        F.lit(100),
        F.when(F.coalesce("verified_payment_surface", F.lit(False)), 70).otherwise(0)
        + F.when(F.col("label") == "machine_payable", 20).otherwise(0)
        + F.when(F.coalesce("payment_surface", F.lit("")) != "", 10).otherwise(0)
        + F.when(F.coalesce("priced_action_count", F.lit(0)) != 0, 10).otherwise(0),
    )
    parts = df.withColumns(
        {
            "score_readable": _weighted(V.READABLE_WEIGHTS),
            "score_callable": _weighted(V.CALLABLE_WEIGHTS),
            "score_commerce": _weighted(V.COMMERCE_WEIGHTS),
            "score_payment": payment,
        }
    )
    blend = (
        F.col("score_readable") * F.lit(0.3)
        + F.col("score_callable") * F.lit(0.25)
        + F.col("score_commerce") * F.lit(0.25)
        + F.col("score_payment") * F.lit(0.2)
    )
    return parts.withColumn("score_overall", F.bround(blend, 0).cast("int"))


def spoken(c: Column) -> Column:
    """A value name as words; null when empty."""
    return F.replace(blank_to_null(strip(c)), F.lit("_"), F.lit(" "))


def _boundary(name: str) -> Column:
    words = spoken(F.col(f"{name}_boundary"))
    return F.when(words != "unknown", F.concat(F.lit(f"{name} "), words))


def description() -> Column:
    """Known parts of an index row joined by ` | `; null when there is none."""

    def count(column: str, noun: str) -> Column:
        return F.when(F.col(column) != 0, F.concat(F.col(column).cast("string"), F.lit(f" {noun}")))

    label = spoken(F.col("label"))
    text = F.concat_ws(
        " | ",
        F.when(label != "unknown", label),
        spoken(F.col("payment_surface")),
        F.concat(F.lit("score "), F.col("score_overall").cast("string")),
        F.coalesce(
            count("product_count", "products"),
            count("offer_count", "offers"),
            count("priced_action_count", "priced actions"),
        ),
        _boundary("purchase"),
        _boundary("control"),
    )
    return blank_to_null(text)


def probe_summary(probes: str = "probes") -> Column:
    """Seven fields of the best outcome of each public group; a group without outcome is null."""
    names = ["status", "http_status", "content_type", "final_url", "byte_count", "body_sha256", "detail"]

    def brief(keys: list[str]) -> Column:
        return let(
            best_outcome(keys, probes),
            lambda o: F.when(o.isNotNull(), F.struct(*[o[n].alias(n) for n in names])),
        )

    return F.struct(*[brief(keys).alias(group) for group, keys in V.SUMMARY_GROUPS.items()])
