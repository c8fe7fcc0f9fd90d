"""Publication sinks: JSON documents under fixed keys, the rerun list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compact_json(value: Column) -> Column:
    """JSON text that keeps null members."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def document(kind: str, key: Column, payload: Column) -> list[Column]:
    return [F.lit(kind).alias("kind"), key.alias("key"), payload.alias("payload")]


def write_documents(documents: DataFrame, path: str) -> None:
    """(kind, key, payload) rows, one folder per kind; earlier output is replaced."""
    documents.write.mode("overwrite").partitionBy("kind").json(path)


def write_rerun_list(selection: DataFrame, path: str) -> None:
    """`rank,domain` lines in list order; a missing rank leaves the first cell empty."""
    line = F.concat_ws(",", F.coalesce(F.col("rank").cast("string"), F.lit("")), F.col("domain"))
    selection.orderBy("row_index").select(line.alias("value")).write.mode("overwrite").text(path)
