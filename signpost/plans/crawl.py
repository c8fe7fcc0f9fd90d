"""Fetch log -> outcomes -> receipts, positives and evidence."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions import documents as D
from signpost.operators import classify, outcomes, select
from signpost.operators.facts.registry import VALIDATORS, Validator
from signpost.session import prepare, scratch_path, stored
from signpost.plans.followups import with_follow_ups
from signpost.sources.fetches import lookup, with_request_id

OUTCOME_COLUMNS = [
    "domain", "attempt", "probe_key", "path", "status", "http_status", "content_type", "final_url", "byte_count", "body_sha256",
    "detail", "facts", "fetched_at", "request_id",
]
CAPTURE_COLUMNS = [
    "domain", "attempt", "probe_key", "validator", "control_group", "requested_url", "http_status", "content_type", "final_url", "byte_count",
    "body_sha256", "fetched_at", "request_id",
]
NO_VALIDATOR = "No validator for this probe"
JOBS_AT_ONCE = 3


def _judged(rows: DataFrame, validator: Validator) -> DataFrame:
    """Undecided responses with the validator's verdict and the facts, or what is noted of rejected ones; bodies go."""
    found = validator.job(rows.drop("status", "detail"))
    facts = F.to_variant_object(F.col("facts"))
    if "rejection" in found.columns:
        noted = D.present(F.col("rejection"))
        facts = F.when(F.col("is_valid"), facts).when(F.size(noted) > 0, F.to_variant_object(noted))
    found = found.withColumn("facts", facts)
    verdict = F.when(F.col("is_valid"), "valid").otherwise("invalid")
    return found.withColumn("verdict", verdict)


def _over_cores(rows: DataFrame) -> DataFrame:
    """The rows dealt over all cores where their files make fewer tasks: small compressed bodies of one kind lie in few files, and judging one takes much longer than moving it."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # dealt by a hash: dealing in turn sorts whole rows, bodies included, in every task
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, F.xxhash64("domain", "attempt", "probe_key", "request_id", "fetched_at"))


def _verdicts(undecided: DataFrame, catalog: dict[str, Validator]) -> DataFrame | None:
    """The verdicts of all validators that have rows, each written by a job of its own and read back as one table.

    Only the validators the log needs are planned, every plan holds one fact job, and a few of them are
    built and run at a time: building one is mostly waiting for the JVM.
    """
    spark = undecided.sparkSession
    present = {r[0] for r in undecided.select("validator").distinct().collect()}  # at most the catalogue's names
    jobs = {name: v for name, v in catalog.items() if name in present}
    if not jobs:
        return None
    path = scratch_path(spark, "verdicts")

    def write(name: str) -> None:
        rows = _over_cores(undecided.where(F.col("validator") == name))
        _shaped(_judged(rows, jobs[name])).drop("validator").write.parquet(f"{path}/validator={name}")

    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), jobs))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _shaped(undecided).schema.fields)
    return spark.read.schema(columns).parquet(path)


def _shaped(part: DataFrame) -> DataFrame:
    extra = {"status": "string", "verdict": "string", "detail": "string", "facts": "variant"}
    return part.select(*CAPTURE_COLUMNS, *[(F.col(c) if c in part.columns else F.lit(None)).cast(t).alias(c) for c, t in extra.items()])


def verdicts_from_fetches(fetches: DataFrame, validators: dict[str, Validator] | None = None) -> DataFrame:
    """Every response with the status its ladder gives, else the verdict of its validator; before the control match.

    The log is scanned once. What the ladder leaves open is stored by validator with its bodies, so every
    fact job reads its own part only. Responses to probes nobody judges stay, as `unknown`.
    """
    catalog = VALIDATORS if validators is None else validators
    prepare(fetches.sparkSession)
    ladder = outcomes.laddered(with_request_id(fetches), catalog)
    open_ = F.col("status").isNull()
    staged = stored(ladder.withColumn("body", F.when(open_, F.col("body"))).withColumn("open", open_), "ladder", ["open", "validator"])
    undecided = staged.where("open").drop("open")
    limited = F.when(F.col("retry_after_seconds").isNotNull(), F.to_variant_object(F.struct("retry_after_seconds")))
    parts = [
        _verdicts(undecided, catalog),
        _shaped(staged.where("NOT open").withColumn("facts", limited)),
        _shaped(undecided.where(~F.col("validator").isin(*catalog)).withColumns({"verdict": F.lit("unknown"), "detail": F.lit(NO_VALIDATOR)})),
    ]
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])


def outcomes_from_fetches(fetches: DataFrame, validators: dict[str, Validator] | None = None, controls: DataFrame | None = None) -> DataFrame:
    """All outcomes of a fetch log read by `read_fetches`; `controls` are control digests from elsewhere.

    The log is scanned twice: once for the narrow control digests, once for the verdicts, which meet the
    digests, without bodies, in a single join.
    """
    rows = verdicts_from_fetches(fetches, validators)
    digests = outcomes.control_signatures(fetches)
    if controls is not None:
        digests = digests.unionByName(controls).groupBy("domain", "attempt", "control_group").agg(F.min("control").alias("control"))
    return outcomes_of_verdicts(outcomes.with_fallback(rows, digests), validators)


def outcomes_of_verdicts(matched: DataFrame, validators: dict[str, Validator] | None = None) -> DataFrame:
    """Outcome rows of verdicts that met their control digests."""
    undecided_still = F.col("status").isNull()
    final = matched.withColumns({
        "facts": F.when(F.col("status").eqNullSafe("fallback"), None).otherwise(F.col("facts")),
        "status": F.when(undecided_still, F.col("verdict")).otherwise(F.col("status")),
    })
    return final.withColumn("path", _path(VALIDATORS if validators is None else validators)).select(*OUTCOME_COLUMNS)


def _path(catalog: dict[str, Validator]) -> Column:
    path = lookup({key: p[0] for v in catalog.values() for key, p in v.probes.items()}, F.col("probe_key"))
    return F.when(path == "dynamic", F.col("requested_url")).otherwise(F.coalesce(path, F.col("requested_url")))


def receipts_from_outcomes(all_outcomes: DataFrame, order: str = "fetched_at", base_delay: float = 4.0) -> DataFrame:
    """One receipt per domain: outcomes merged per attempt, classified, the best attempt kept with the retry figures."""
    keys = ["domain", "attempt"]
    full = outcomes.complete_outcomes(all_outcomes)
    rows = classify.classified(classify.pivot_outcomes(full, keys, order=order))
    return classify.as_document(select.settled_attempts(classify.receipts_of(rows, keys), base_delay))


def receipts_from_fetches(fetches: DataFrame, domains: DataFrame | None = None, validators: dict[str, Validator] | None = None) -> DataFrame:
    """The whole crawl side; with the domain list the receipts also carry rank and row index.

    Two rounds: the outcomes of every capture, then those of the follow-up requests the first ones ask for.
    Each is stored once: bodies are parsed a single time, and a lost executor repeats no parsing.
    """
    first = stored(outcomes_from_fetches(fetches, validators), "outcomes")
    receipts = receipts_from_outcomes(stored(with_follow_ups(first, fetches), "followed"))
    return receipts if domains is None else receipts.join(domains, "domain", "left")


def with_signal(receipts: DataFrame) -> DataFrame:
    """`is_interesting`: some probe that counts as a signal is valid."""
    hits = [F.coalesce(F.col(f"probes.{k}.status") == "valid", F.lit(False)) for k in V.INTERESTING_PROBES]
    return receipts.withColumn("is_interesting", reduce(lambda a, b: a | b, hits))


def positives_of(receipts: DataFrame, order: str = "crawled_at") -> DataFrame:
    """The last receipt of every domain whose last receipt has a signal."""
    return select.positives(with_signal(receipts), order=order)


def evidence_of(receipts: DataFrame, fetches: DataFrame) -> DataFrame:
    """(domain, artifact, body) for the receipts of one crawl: the captures their text outcomes come from."""
    marked = with_signal(receipts).where("is_interesting")
    cells = F.array(*[F.struct(F.lit(k).alias("probe_key"), F.col(f"probes.{k}.status").alias("status"), F.col(f"probes.{k}.body_sha256").alias("body_sha256")) for k in V.EVIDENCE_PROBES])
    wanted = marked.select("domain", "attempt", F.inline(cells)).where("status = 'valid'").drop("status")
    texts = fetches.where(F.col("probe_key").isin(*V.EVIDENCE_PROBES) & ~F.coalesce(F.col("truncated"), F.lit(False)) & (F.octet_length("body") > 0))
    bodies = texts.select("domain", "attempt", "probe_key", "body_sha256", "body").join(wanted, ["domain", "attempt", "probe_key", "body_sha256"], "left_semi")
    return bodies.dropDuplicates(["domain", "probe_key"]).select("domain", F.col("probe_key").alias("artifact"), "body")
