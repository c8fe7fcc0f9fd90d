"""The fetch log: captured responses, cut to each probe's body limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions.text import strip
from signpost.session import prepare

CONTROL_PREFIX = "control:"


def lookup(values: dict, key: Column) -> Column:
    """A small fixed table as a map literal; null for every key when the table is empty."""
    if not values:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def body_limit(probe_key: Column, limits: dict[str, int] | None = None) -> Column:
    """Control responses are read with a smaller limit than the pages they are compared with."""
    probe = F.coalesce(lookup(V.MAX_BYTES_OF | (limits or {}), probe_key), F.lit(V.DEFAULT_MAX_BYTES))
    return F.when(probe_key.startswith(CONTROL_PREFIX), F.lit(V.CONTROL_MAX_BYTES)).otherwise(probe)


def limit_bodies(raw: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """Apply the limits: `body` cut, `truncated` set, `byte_count` and `body_sha256` derived."""
    limit = body_limit(F.col("probe_key"), limits)
    body = F.coalesce(F.col("body"), F.lit(b""))
    cut = raw.withColumn("truncated", F.coalesce(F.octet_length(body) > limit, F.lit(False))).withColumn(
        "body", F.substring(body, F.lit(1), limit)
    )
    size = F.octet_length("body").cast("bigint")
    return cut.withColumn("byte_count", size).withColumn("body_sha256", F.when(size > 0, F.sha2("body", 256)))


def clean_headers(headers: Column) -> Column:
    """Lower-cased names, stripped values; of equal names the last one counts."""
    named = F.filter(
        F.transform(
            F.map_entries(headers),
            lambda e: F.struct(F.lower(strip(e["key"])).alias("key"), strip(e["value"]).alias("value")),
        ),
        lambda e: (e["key"] != "") & e["value"].isNotNull(),
    )
    last = F.filter(named, lambda e, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda f: f["key"] == e["key"]))
    return F.map_from_entries(last)


def request_id(kind: Column, method: Column, url: Column, note: Column) -> Column:
    """Names a request: what it is for, method, address, and the words a search asks for (null for none)."""
    return F.md5(F.concat_ws("\n", kind, F.upper(F.coalesce(method, F.lit("GET"))), F.coalesce(url, F.lit("")), note))


def with_request_id(fetches: DataFrame) -> DataFrame:
    """`request_id` of every capture, as logged or, where the log has none, from what was requested."""
    has = lambda c: F.col(c) if c in fetches.columns else F.lit(None).cast("string")
    derived = request_id(F.col("probe_key"), has("request_method"), F.col("requested_url"), has("request_note"))
    return fetches.withColumn("request_id", F.coalesce(has("request_id"), derived))


def read_fetches(spark: SparkSession, path: str, limits: dict[str, int] | None = None) -> DataFrame:
    """Parquet fetch log; `limits` are those of probes the catalogue does not have."""
    rows = limit_bodies(prepare(spark).read.parquet(path), limits).withColumn("headers", clean_headers(F.col("headers")))
    return with_request_id(rows)
