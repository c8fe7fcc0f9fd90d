"""Shared steps of the fact jobs: one pass over the body column, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost.functions.stage import compute
from signpost.functions.text import strip, utf8


def documents(fetches: DataFrame) -> DataFrame:
    """`text` (decoded, stripped) and `base` (address the document was read from); the body goes."""
    kept = [c for c in fetches.columns if c != "body"]
    base = F.coalesce("final_url", "requested_url") if {"final_url", "requested_url"} <= set(kept) else F.lit(None).cast("string")
    return compute(fetches, kept, text=strip(utf8(F.coalesce(F.col("body"), F.lit(b"")))), base=base)


def judged(df: DataFrame, rejections: list[tuple[Column, str | Column]], accepted: str | Column) -> DataFrame:
    """`is_valid` and `detail`: the first rejection that applies, else acceptance."""
    as_column = lambda d: d if isinstance(d, Column) else F.lit(d)
    reason = F.lit(None).cast("string")
    for test, detail in reversed(rejections):
        reason = F.when(F.coalesce(test, F.lit(False)), as_column(detail)).otherwise(reason)
    staged = compute(df, _reason=reason)
    return staged.withColumns(
        {"is_valid": F.col("_reason").isNull(), "detail": F.coalesce(F.col("_reason"), as_column(accepted))}
    ).drop("_reason")


def finished(df: DataFrame, facts: Column, keep_invalid: bool = False, rejected: dict[str, Column] | None = None) -> DataFrame:
    """Attach the facts (of valid documents unless told otherwise) and drop the working columns.

    `rejected` is what is noted of invalid documents; it becomes the struct `rejection`, null for valid ones.
    """
    found = [(facts if keep_invalid else F.when(F.col("is_valid"), facts)).alias("facts")]
    if rejected:
        found.append(F.when(~F.col("is_valid"), F.struct(*[c.alias(n) for n, c in rejected.items()])).alias("rejection"))
    kept = [c for c in df.columns if c not in ("text", "base", "headers") and not c.startswith("_")]
    return df.select(*kept, *found)


def because(value: Column, *details: str) -> Column:
    """A value noted of documents that are rejected for one of these reasons."""
    return F.when(F.col("detail").isin(*details), value)


def was_truncated() -> Column:
    return F.when(F.col("truncated"), True)


def truncated(noun: str) -> tuple[Column, Column]:
    detail = F.concat(F.lit(f"{noun} truncated at "), F.col("byte_count").cast("string"), F.lit(" bytes"))
    return F.col("truncated"), detail


def starts_json() -> Column:
    return F.substring("text", 1, 1).isin("[", "{")
