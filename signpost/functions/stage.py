"""Named intermediate results that are computed exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute(df: DataFrame, keep: list[str] | None = None, **columns: Column) -> DataFrame:
    """Add columns that later steps may use freely.

    Neighbouring projections are merged by the optimiser, which repeats an expression at each use.
    A one-row generator in between is not merged. The values themselves are built in an ordinary
    (compiled) projection; the generator only unpacks them.
    """
    kept = [k for k in (df.columns if keep is None else keep) if k not in columns]
    return spread(df, kept, F.struct(*[c.alias(n) for n, c in columns.items()]))


def spread(df: DataFrame, keep: list[str], value: Column) -> DataFrame:
    """Turn the members of a struct into columns, evaluating the struct once."""
    packed = df.select(*keep, value.alias("_packed"))
    return packed.select(*keep, F.inline(F.array("_packed")))
