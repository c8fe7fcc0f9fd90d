"""The receipt log: NDJSON shards in, NDJSON shards out."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signpost import values as V
from signpost.functions import documents as D
from signpost.functions.stage import compute
from signpost.functions.text import strip
from signpost.session import child_names, prepare, ship_package
from signpost.sources.position import append_order, read_lines

SHARD_RECORDS = 100_000
SHARD_BYTES = 128 << 20
_OUTCOME = ",".join(f"`{n}`:variant" for n in V.OUTCOME_MEMBERS)
# a line's members down to those of its probes, taken in one look; objects of another type are null
LINE_MEMBERS = "struct<" + ",".join([
    *[f"{n}:variant" for n in ("domain", "rank", "row_index", "crawled_at", "label", "tags", "title", "aggregates")],
    "probes:struct<" + ",".join(f"`{k}`:struct<{_OUTCOME}>" for k in V.PROBE_ORDER) + ">"]) + ">"


def parse_receipt_lines(lines: DataFrame, strict: bool) -> DataFrame:
    """(line, pos) -> receipt columns, `probes` as a struct with one outcome per known probe key.

    A line either is a JSON object or not; that alone decides. Strict parsing fails on a line that is
    none, lenient parsing drops it. Members are read afterwards, each on its own: one of an unexpected
    type is null (or read as what it says, like a status in quotes) and takes no other with it.
    """
    kept = compute(lines, ["pos"], line=strip(F.col("line"))).where("line <> ''")
    read = compute(kept, ["pos", "line"], value=D.value_of(F.col("line")))
    read = compute(read, ["pos", "line"], receipt=F.try_variant_get("value", "$", LINE_MEMBERS))
    is_object = F.col("receipt").isNotNull()
    if strict:
        broken = F.concat(F.lit("a line of the receipt log is no JSON object: "), F.substring("line", 1, 200))
        read = read.where(F.when(is_object, F.lit(True)).otherwise(F.raise_error(broken).cast("boolean")))
    else:
        read = read.where(is_object)
    return read.select("pos", *_receipt(F.col("receipt")))


def _receipt(line: Column) -> list[Column]:
    """The columns of RECEIPT_LINE from a line's members; those a query does not use are not built."""
    whole = lambda v: F.coalesce(D.as_whole(v), F.try_variant_get(v, "$", "bigint"))

    def outcome(key: str) -> Column:
        o = line["probes"][key]
        typed = {n: whole(o[n]) if n in ("http_status", "byte_count") else D.as_string(o[n]) for n in V.OUTCOME_MEMBERS if n != "facts"}
        typed["http_status"] = typed["http_status"].try_cast("int")
        return F.when(o.isNotNull(), F.struct(*[c.alias(n) for n, c in typed.items()], o["facts"].alias("facts")))

    return [
        D.as_string(line["domain"]).alias("domain"), line["rank"].alias("rank"), whole(line["row_index"]).alias("row_index"),
        line["crawled_at"].alias("crawled_at"), D.as_string(line["label"]).alias("label"),
        *[line[n].alias(n) for n in ("tags", "title", "aggregates")],
        F.struct(*[outcome(k).alias(k) for k in V.PROBE_ORDER]).alias("probes"),
    ]


def read_receipts(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Receipts with `pos`, their place in append order. `path` may be a directory or a glob."""
    lines = read_lines(prepare(spark), path).select("line", append_order().alias("pos"))
    return parse_receipt_lines(lines, strict)


def probe_status(key: str) -> Column:
    return F.col(f"probes.{key}.status")


def receipt_lines(receipts: DataFrame) -> DataFrame:
    """(line): compact JSON with sorted members. Null members are written, probes a receipt does not have are not."""
    columns = sorted(c for c in receipts.columns if c in (
        "aggregates", "crawled_at", "domain", "label", "probes", "rank", "row_index", "tags", "title"))
    value = {c: F.col(c) for c in columns}
    if "probes" in value and isinstance(receipts.schema["probes"].dataType, StructType):
        cells = [x for k in sorted(receipts.schema["probes"].dataType.names) for x in (F.lit(k), F.col(f"probes.{k}"))]
        value["probes"] = F.map_filter(F.create_map(*cells), lambda _, o: o.isNotNull())
    return receipts.select(F.to_json(F.struct(*[c.alias(n) for n, c in value.items()]), {"ignoreNullFields": "false"}).alias("line"))


def sharded(lines: DataFrame, run: int, max_records: int, max_bytes: int) -> DataFrame:
    """(shard, seq, line): shards in the order of the rows; a new one starts where a line would go over a limit (0: none).

    Every task fills shards of its own, so only a task's running count and size are held. A line longer
    than `max_bytes` is a shard by itself.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        task, shard, records, size, seq = TaskContext.get().partitionId(), 0, 0, 0, 0
        for batch in batches:
            names = []
            for length in pc.binary_length(batch.column(0)).to_pylist():
                length += 1  # the line break
                if records and ((max_records and records >= max_records) or (max_bytes and size + length > max_bytes)):
                    shard, records, size = shard + 1, 0, 0
                records, size = records + 1, size + length
                names.append(f"{run:06d}-{task:06d}-{shard:06d}")
            order = pa.array(range(seq, seq + len(names)), pa.int64())
            seq += len(names)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), order, batch.column(0)], names=["shard", "seq", "line"])

    ship_package(lines.sparkSession)
    return lines.mapInArrow(read, "shard string, seq long, line string")


def write_receipts(receipts: DataFrame, path: str, max_records: int = SHARD_RECORDS, max_bytes: int = SHARD_BYTES) -> None:
    """Append receipts as NDJSON shards, one file each, rotated by records and by bytes; their names keep the append order."""
    run = next_run(receipts.sparkSession, path)
    rows = sharded(receipt_lines(receipts), run, max_records, max_bytes).sortWithinPartitions("shard", "seq")
    rows.select("shard", F.col("line").alias("value")).write.mode("append").partitionBy("shard").text(path)


def next_run(spark: SparkSession, path: str) -> int:
    """One more than the last run that wrote shards under `path`."""
    names = child_names(spark, path)
    return 1 + max((int(n[6:12]) for n in names if re.fullmatch(r"shard=\d{6}-\d{6}-\d{6}", n)), default=-1)


def seen_domains(receipts: DataFrame) -> DataFrame:
    """Domains already in the log, lower-cased and stripped."""
    name = F.lower(strip(F.col("domain")))
    return receipts.select(name.alias("domain")).where("domain <> ''").distinct()


def unseen(domains: DataFrame, receipts: DataFrame) -> DataFrame:
    return domains.join(seen_domains(receipts), "domain", "left_anti")
