"""The growing logs as streams: outcomes, running counts, throughput, positives, unseen domains."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signpost.operators import outcomes
from signpost.operators.select import positives
from signpost.plans.crawl import outcomes_from_fetches, outcomes_of_verdicts, verdicts_from_fetches
from signpost.sources.receipts import seen_domains

AVAILABLE = {"availableNow": True}


def record_outcomes(
    fetches: DataFrame, path: str, checkpoint: str, controls: DataFrame | None = None, validators: dict | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Whole outcomes of a fetch stream, batch by batch, into folders named after the batch.

    A batch goes through the same plan as a log: ladder, fact jobs, control match. Its control digests
    are those captured in the batch and those of `controls`, a table made by `control_signatures`.
    A repeated batch writes the same folder again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        outcomes_from_fetches(batch, validators, controls).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return fetches.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE)).start()


def record_verdicts(fetches: DataFrame, path: str, checkpoint: str, validators: dict | None = None, trigger: dict | None = None) -> StreamingQuery:
    """The first half of the streamed crawl: verdicts and control digests of every batch, as two logs under `path`.

    A batch of a log appears at once and only once: it is written aside and renamed, and a repeated batch
    whose folder is there already is left alone, so what follows the logs sees no row twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _appear(f"{path}/verdicts", batch_id, lambda: verdicts_from_fetches(batch, validators))
        _appear(f"{path}/controls", batch_id, lambda: outcomes.control_signatures(batch, timed=True))

    return fetches.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE)).start()


def _appear(log: str, batch_id: int, rows: Callable[[], DataFrame]) -> None:
    spark = SparkSession.active()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    parent, aside, target = hadoop(log), hadoop(f"{log}/.aside-{batch_id}"), hadoop(f"{log}/{batch_id:012d}")
    system = parent.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(target):
        return
    rows().write.mode("overwrite").parquet(aside.toString())
    system.rename(aside, target)


VERDICT_LOG = (
    "domain string, attempt int, probe_key string, validator string, control_group string, requested_url string, http_status int, content_type string, "
    "final_url string, byte_count long, body_sha256 string, fetched_at timestamp, request_id string, status string, verdict string, detail string, facts variant"
)
CONTROL_LOG = (
    "domain string, attempt int, control_group string, control struct<http_status:int,media:string,byte_count:long,body_sha256:string>, captured_at timestamp"
)


def matched_outcomes(spark: SparkSession, path: str, late: str = "1 day", validators: dict | None = None, files: int | None = None) -> DataFrame:
    """The second half: the two logs of `record_verdicts` as streams, joined to whole outcomes.

    A page and its control may come in any order and in any batches, as long as they were captured within
    `late` of each other. A page waits in the join's state until its control comes or the watermarks of both
    logs have passed it; then it goes on without one. Only undecided pages of a control group wait, and without
    bodies. The watermarks move with pages that wait and with controls. Of repeated controls the first to come counts.
    `files` limits what a batch takes of each log.
    """
    reader = lambda schema: spark.readStream.schema(schema).options(**({"maxFilesPerTrigger": files} if files else {}))
    verdicts = reader(VERDICT_LOG).parquet(f"{path}/verdicts/*")
    digests = reader(CONTROL_LOG).parquet(f"{path}/controls/*")
    keys = ["domain", "attempt", "control_group"]
    first = digests.withWatermark("captured_at", late).dropDuplicatesWithinWatermark(keys)
    named = first.select(*[F.col(k).alias(f"_{k}") for k in keys], "control", "captured_at")
    waits = F.col("status").isNull() & F.col("control_group").isNotNull()
    near = F.expr(f"captured_at BETWEEN fetched_at - INTERVAL {late} AND fetched_at + INTERVAL {late}")
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    joined = verdicts.withWatermark("fetched_at", late).where(waits).join(named, [*same, near], "leftOuter")
    marked = joined.withColumn("matches_control", outcomes.equals_control()).select(*verdicts.columns, "matches_control")
    rest = verdicts.where(~waits).withColumn("matches_control", F.lit(False))
    return outcomes_of_verdicts(outcomes.fallen_back(marked.union(rest)), validators)


def label_counts(receipts: DataFrame) -> DataFrame:
    """Running count per label; ten groups at most."""
    return receipts.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def status_counts(outcome_rows: DataFrame) -> DataFrame:
    """Running count per probe and status; bounded by the catalogue."""
    return outcome_rows.groupBy("probe_key", "status").agg(F.count(F.lit(1)).alias("n"))


def throughput(receipts: DataFrame, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Receipts per interval of crawl time, for update mode: an interval comes out with each batch that
    changes it, so the last ones do too, and its state goes once the watermark has passed it.
    """
    windows = receipts.withWatermark("crawled_at", late).groupBy(F.window("crawled_at", every)).agg(F.count(F.lit(1)).alias("receipts"))
    return windows.select(F.col("window.start").alias("started_at"), "receipts")


def unseen_stream(domains: DataFrame, seen_log: DataFrame, event_time: str, horizon: str) -> DataFrame:
    """Domains of a stream that the log does not have, each once within the horizon."""
    fresh = domains.join(seen_domains(seen_log), "domain", "left_anti")
    return fresh.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(["domain"])


def last_states(receipts: DataFrame) -> DataFrame:
    """The last receipt per domain by position."""
    kept = [c for c in receipts.columns if c != "domain"]
    return receipts.groupBy("domain").agg(F.max_by(F.struct(*kept), "pos").alias("last")).select("domain", "last.*")


def keep_positives(receipts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, compact_every: int = 20) -> StreamingQuery:
    """Record the last receipt of every domain, batch by batch.

    A batch reduces to its own last receipts and writes only those, to a folder named after the batch:
    a repeated batch writes the same folder again. Every `compact_every` batches the folders so far
    become one, so readers never scan more than that many. Readers take the latest position over all
    folders; rows that stand in two of them while a compaction is repeated change nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        last_states(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if batch_id and batch_id % compact_every == 0:
            compact_positives(batch.sparkSession, path, batch_id)

    return receipts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE)).start()


def _folders(spark: SparkSession, path: str) -> tuple[object, dict[str, int]]:
    """The file system of `path`, and its batch folders with their last batch."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(root) if s.isDirectory()]
    return system, {n: int(n.split("=")[1].split("-")[-1]) for n in names if n.startswith(("batch=", "upto="))}


def compact_positives(spark: SparkSession, path: str, batch_id: int) -> None:
    """The folders up to a batch as a single one, written first and put in place of the others then."""
    system, found = _folders(spark, path)
    old = [n for n, last in found.items() if last <= batch_id]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    new = f"upto=0-{batch_id}"
    last_states(spark.read.parquet(*[f"{path}/{n}" for n in old])).write.mode("overwrite").parquet(f"{path}/.next")
    system.delete(hadoop(f"{path}/{new}"), True)
    system.rename(hadoop(f"{path}/.next"), hadoop(f"{path}/{new}"))
    for name in old:
        if name != new:
            system.delete(hadoop(f"{path}/{name}"), True)


def read_positives(spark: SparkSession, path: str) -> DataFrame:
    """Domains whose last recorded receipt has a signal; those that lost it are gone."""
    return positives(spark.read.parquet(*[f"{path}/{n}" for n in _folders(spark, path)[1]]))


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: dict | None = None) -> None:
    """Run a stream and wait for its end. Append results accumulate, complete ones replace the table, and
    updates go to a folder per batch: of equal keys the one of the highest `batch` counts.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE))
    if mode == "append":
        query = writer.outputMode("append").format("parquet").start(path)
    elif mode == "update":
        query = writer.outputMode(mode).foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}")).start()
    else:
        query = writer.outputMode(mode).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path)).start()
    query.awaitTermination()
