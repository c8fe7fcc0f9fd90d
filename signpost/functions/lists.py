"""Ordered-distinct list arithmetic inside a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from signpost.functions.text import strip

NO_STRINGS = "array<string>"


def empty_strings() -> Column:
    return F.array().cast(NO_STRINGS)


def or_empty(c: Column) -> Column:
    return F.coalesce(c, empty_strings())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`."""
    return F.transform(F.array(value), body).getItem(0)


def cleaned(values: Column) -> Column:
    """Stripped, non-empty strings in their order."""
    stripped = F.transform(or_empty(values), strip)
    return F.filter(stripped, lambda x: x.isNotNull() & (x != ""))


def merge_ordered(existing: Column, values: Column, limit: int) -> Column:
    """First occurrence wins, existing order first, at most `limit`."""
    return F.slice(F.array_distinct(F.concat(or_empty(existing), cleaned(values))), 1, limit)


def merge_all(lists: list[Column], limit: int | None) -> Column:
    joined = F.array_distinct(F.concat(*[cleaned(x) for x in lists]))
    return joined if limit is None else F.slice(joined, 1, limit)


def sorted_distinct(values: Column, limit: int) -> Column:
    return F.slice(F.array_sort(F.array_distinct(or_empty(values))), 1, limit)


def non_empty(values: Column) -> Column:
    return F.when(F.size(values) > 0, values)


def first_by_key(items: Column, key: Callable[[Column], Column], limit: int) -> Column:
    """Items with a new key, in order, at most `limit`.

    Keys are compared as JSON text, which the distinct step hashes; only the few kept keys are looked
    up again, so long arrays cost linear time.
    """
    as_text = {"ignoreNullFields": "false"}
    keys = F.transform(items, lambda x: F.to_json(F.struct(key(x).alias("k")), as_text))
    return let(
        F.struct(items.alias("items"), keys.alias("keys")),
        lambda s: F.transform(
            F.slice(F.array_distinct(s["keys"]), 1, limit),
            lambda k: F.get(s["items"], (F.array_position(s["keys"], k) - 1).cast("int")),
        ),
    )
