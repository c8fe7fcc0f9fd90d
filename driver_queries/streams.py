"""Streaming jobs run over the event table until nothing is left, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driver_queries.base import RECEIPT_LOG, query, run_sql, table
from driver_queries.crawl import CRAWL_OUTCOMES, crawl_columns, crawl_fetches
from driver_queries.receipts import LAST_STATE
from signpost.operators import outcomes
from signpost.session import scratch_path
from signpost.streaming import jobs, state


def streamed(spark, sf, sql, files: int = 1) -> DataFrame:
    """The rows of an adapter as a file stream. With more files the stream takes several batches."""
    path = scratch_path(spark, "input")
    rows = run_sql(spark, sf, sql).withColumn("ts", F.col("ts").cast("timestamp"))
    rows.repartitionByRange(files, "pos").write.parquet(path)
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return (reader.option("maxFilesPerTrigger", 1) if files > 1 else reader).parquet(path)


def finished(spark, stream: DataFrame, mode: str = "append") -> DataFrame:
    path = scratch_path(spark, "output")
    jobs.run_available(stream, path, scratch_path(spark, "progress"), mode)
    return spark.read.parquet(path)


def stream_of_outcomes(spark, sf) -> DataFrame:
    path, out = scratch_path(spark, "input"), scratch_path(spark, "output")
    crawl_fetches(spark, sf).repartitionByRange(2, "attempt").write.parquet(path)
    rows = spark.read.parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    # a batch may come before the controls of its domains: the digests of the whole log are a table
    jobs.record_outcomes(stream, out, scratch_path(spark, "progress"), outcomes.control_signatures(rows)).awaitTermination()
    return spark.read.parquet(out)


@query("stream_outcomes", CRAWL_OUTCOMES)
def stream_outcomes(spark, sf):
    """Pages in two batches, all their controls in a third; a fourth with a later page that waits, and its control, moves the watermarks past them."""
    path, out, progress = scratch_path(spark, "input"), scratch_path(spark, "output"), scratch_path(spark, "progress")
    log = crawl_fetches(spark, sf)
    control = outcomes.is_control()
    known = {"domain": F.lit("later.example"), "attempt": F.lit(1), "fetched_at": F.lit("2025-12-31").cast("timestamp"), "http_status": F.lit(200), "body": F.lit(b"User-agent: *"),
             "byte_count": F.lit(13).cast("long"), "probe_key": F.explode(F.array(F.lit("robots_txt"), F.lit("control:text")))}
    ends = spark.range(1).select(*[known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in log.schema.fields])
    files = spark.sparkContext.defaultParallelism
    for i, part in enumerate([log.where(~control & (F.col("attempt") == 1)), log.where(~control & (F.col("attempt") == 2)), log.where(control), ends]):
        part.repartition(files).write.parquet(f"{path}/{i}")
        # what has come since the last run is one batch, read by all cores
        stream = spark.readStream.schema(log.schema).parquet(f"{path}/*")
        jobs.record_verdicts(stream, out, progress).awaitTermination()
    rows = finished(spark, jobs.matched_outcomes(spark, out, "300 days", files=files))
    return crawl_columns(rows.where("domain <> 'later.example'"))


@query("stream_counts", f"SELECT probe_key, status, count(*) AS n FROM ({CRAWL_OUTCOMES}) o GROUP BY ALL")
def stream_counts(spark, sf):
    path = scratch_path(spark, "rows")
    stream_of_outcomes(spark, sf).select("probe_key", "status").write.parquet(path)
    rows = spark.readStream.schema("probe_key string, status string").parquet(path)
    return finished(spark, jobs.status_counts(rows), "complete")


@query("stream_labels", f"SELECT label, count(*) AS n FROM ({RECEIPT_LOG}) r GROUP BY label")
def stream_labels(spark, sf):
    return finished(spark, jobs.label_counts(streamed(spark, sf, RECEIPT_LOG, files=3)), "complete")


@query("stream_throughput", "SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS started, count(*) AS receipts FROM events GROUP BY 1")
def stream_throughput(spark, sf):
    rows = jobs.throughput(streamed(spark, sf, RECEIPT_LOG, files=3).withColumnRenamed("ts", "crawled_at"), late="60 days")
    changed = finished(spark, rows, "update")
    return changed.groupBy(F.unix_seconds("started_at").alias("started")).agg(F.max_by("receipts", "batch").alias("receipts"))


@query("stream_positives", f"SELECT l.domain, l.last_pos AS pos, r.label FROM ({LAST_STATE}) l JOIN ({RECEIPT_LOG}) r ON r.pos = l.last_pos WHERE l.keep")
def stream_positives(spark, sf):
    state = scratch_path(spark, "state")
    receipts = streamed(spark, sf, RECEIPT_LOG, files=4).select("domain", "pos", "label", "is_interesting")
    jobs.keep_positives(receipts, state, scratch_path(spark, "progress")).awaitTermination()
    return jobs.read_positives(spark, state).select("domain", "pos", "label")


@query("stream_positive_state", f"SELECT l.domain, l.last_pos AS pos, r.label FROM ({LAST_STATE}) l JOIN ({RECEIPT_LOG}) r ON r.pos = l.last_pos WHERE l.keep")
def stream_positive_state(spark, sf):
    """The stream is stopped after half of the log, the later half first, and started again on its checkpoint."""
    path, progress = scratch_path(spark, "input"), scratch_path(spark, "progress")
    rows = run_sql(spark, sf, RECEIPT_LOG).select("domain", F.col("pos").cast("long").alias("pos"), "label", "is_interesting")
    half = rows.agg(F.max("pos")).first()[0] // 2
    files = spark.sparkContext.defaultParallelism
    for part in (rows.where(F.col("pos") > half), rows.where(F.col("pos") <= half)):
        part.repartition(2 * files).write.mode("append").parquet(path)  # two batches, read by all cores
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)
        state.keep_positive_state(stream, progress).awaitTermination()
    return state.read_positive_state(spark, progress).select("domain", "pos", "label")


@query(
    "stream_unseen",
    """SELECT DISTINCT concat('site', user_id, '.example') AS domain FROM events WHERE concat('site', user_id, '.example') NOT IN
       (SELECT concat('site', c_custkey, CASE WHEN c_nationkey < 12 THEN '' ELSE '-other' END, '.example') FROM customer)""",
)
def stream_unseen(spark, sf):
    other = F.when(F.col("c_nationkey") < 12, "").otherwise("-other")
    seen = table(spark, sf, "customer").select(F.concat(F.lit(" SITE"), F.col("c_custkey").cast("string"), other, F.lit(".example ")).alias("domain"))
    domains = streamed(spark, sf, "SELECT event_id AS pos, ts, concat('site', CAST(user_id AS STRING), '.example') AS domain FROM events", files=2)
    return finished(spark, jobs.unseen_stream(domains, seen, "ts", "60 days").select("domain"))
