"""Captured responses to probe outcomes: soft-404 match, login gate, Retry-After, status ladder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions.stage import compute
from signpost.functions.text import contains_any, media_type, strip
from signpost.functions.urls import host
from signpost.operators.facts.registry import VALIDATORS, Validator
from signpost.sources.fetches import CONTROL_PREFIX, lookup


def is_control() -> Column:
    return F.col("probe_key").startswith(CONTROL_PREFIX)


def control_signatures(fetches: DataFrame, timed: bool = False) -> DataFrame:
    """One digest row per (domain, attempt, control_group); of repeated captures the first counts. `timed` adds its time, `captured_at`."""
    signature = F.struct(
        F.col("http_status"), media_type(F.col("content_type")).alias("media"),
        F.when(~F.coalesce("truncated", F.lit(False)), F.col("byte_count")).alias("byte_count"), "body_sha256",
    )
    first = F.min_by(signature, F.struct("fetched_at", "body_sha256"))
    at = [F.min("fetched_at").alias("captured_at")] if timed else []
    return (
        fetches.where(is_control())
        .select("domain", "attempt", "http_status", "content_type", "byte_count", "body_sha256", "truncated", "fetched_at",
                F.expr(f"substring(probe_key, {len(CONTROL_PREFIX) + 1})").alias("control_group"))
        .groupBy("domain", "attempt", "control_group")
        .agg(first.alias("control"), *at)
    )


def equals_control() -> Column:
    """The same 200 answer as the domain's deliberately missing path, whose digest is `control`.

    A cut control goes on where its digest ends: it has no byte count and equals no page, not even one as long as the limit.
    """
    media = media_type(F.col("content_type"))
    same = (
        (F.col("http_status") == 200)
        & (F.col("control.http_status") == 200)
        & media.eqNullSafe(F.col("control.media"))
        & (F.col("byte_count") == F.col("control.byte_count"))
        & F.col("body_sha256").eqNullSafe(F.col("control.body_sha256"))
    )
    return F.coalesce(same, F.lit(False))


def mark_soft404(fetches: DataFrame, controls: DataFrame) -> DataFrame:
    """`matches_control`, by the control digest of the same domain, attempt and group.

    The control side is one narrow row per key, so a hot domain only repeats on the candidate side,
    which the adaptive join may split freely.
    """
    joined = fetches.join(controls, ["domain", "attempt", "control_group"], "left")
    return joined.withColumn("matches_control", equals_control()).drop("control")


def is_login_gate() -> Column:
    """Not the homepage, another final host, and that host looks like a login host."""
    asked, final = host(F.col("requested_url")), host(F.col("final_url"))
    moved = (asked != final) & contains_any(final, V.LOGIN_HOST_MARKERS)
    return (F.col("probe_key") != "homepage") & F.coalesce(moved, F.lit(False))


HTTP_DATE = r"^(?:[A-Za-z]{3}, ?)?\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} (?:[A-Z]{1,4}|[+-]\d{4})$"


def retry_after(header: Column, fetched_at: Column) -> Column:
    """Seconds of a Retry-After header; a date counts from the capture time, never below 0."""
    value = strip(header)
    dated = F.regexp_replace(F.when(value.rlike(HTTP_DATE), value), r"^[A-Za-z]{3}, ?", "")
    moment = F.coalesce(
        F.try_to_timestamp(dated, F.lit("d MMM yyyy HH:mm:ss z")), F.try_to_timestamp(dated, F.lit("d MMM yyyy HH:mm:ss xx"))
    )
    micros = F.unix_micros(moment) - F.unix_micros(fetched_at)
    wait = F.greatest(F.floor(micros / F.lit(1e6)).cast("bigint"), F.lit(0).cast("bigint"))
    return F.when(value.rlike(r"^[0-9]+$"), value.try_cast("bigint")).when(moment.isNotNull(), wait)


def status_allowed(catalog: dict[str, Validator]) -> Column:
    """Whether a validator looks at a response of this status; probes without one take 200 only."""
    special = [(F.col("validator") == name) & F.col("http_status").isin(*v.statuses) for name, v in catalog.items() if tuple(v.statuses) != (200,)]
    named = [name for name, v in catalog.items() if tuple(v.statuses) != (200,)]
    plain = ~F.col("validator").isin(*named) & (F.col("http_status") == 200)
    return F.coalesce(reduce(lambda a, b: a | b, [*special, plain]), F.lit(False))


def with_validator(fetches: DataFrame, catalog: dict[str, Validator]) -> DataFrame:
    named = {key: name for name, v in catalog.items() for key in v.probes}
    return fetches.withColumn("validator", F.coalesce(lookup(named, F.col("probe_key")), F.lit("none")))


def early_status(df: DataFrame, catalog: dict[str, Validator]) -> DataFrame:
    """`status` and `detail` of every rule that needs no look into the body; null where a validator decides.

    Reads `validator`, `byte_count` and `retry_after_seconds`. The control match comes after these rules.
    """
    code = F.col("http_status").cast("string")
    empty_taken = [name for name, v in catalog.items() if v.empty_body]
    empty = (F.col("probe_key") != "homepage") & (F.col("byte_count") == 0) & ~F.col("validator").isin(*empty_taken)
    failed = F.col("http_status").isNull() & (F.coalesce("error", F.lit("")) != "")
    limited = F.when(
        F.col("retry_after_seconds").isNotNull(),
        F.concat(F.lit("HTTP 429 (Retry-After: "), F.col("retry_after_seconds").cast("string"), F.lit("s)")),
    ).otherwise("HTTP 429")
    rungs = [
        (is_login_gate(), "gated", F.lit("Cross-host redirect to login/auth host")),
        (F.col("http_status") == 404, "missing", F.lit("404 not found")),
        (F.col("http_status") == 429, "rate_limited", limited),
        (failed, "error", F.col("error")),
        (~status_allowed(catalog), "http_error", F.concat(F.lit("HTTP "), F.coalesce(code, F.lit("None")))),
        (empty, "invalid", F.lit("Empty response body")),
    ]
    verdict = F.lit(None).cast("struct<status:string,detail:string>")
    for test, status, detail in reversed(rungs):
        verdict = F.when(test, F.struct(F.lit(status).alias("status"), detail.alias("detail"))).otherwise(verdict)
    staged = compute(df, _verdict=verdict)
    return staged.withColumns({"status": F.col("_verdict.status"), "detail": F.col("_verdict.detail")}).drop("_verdict")


def laddered(fetches: DataFrame, catalog: dict[str, Validator] | None = None) -> DataFrame:
    """Probe responses with control group, Retry-After and the status of every rule but the control match."""
    catalog = VALIDATORS if catalog is None else catalog
    limited = F.when(F.col("http_status") == 429, retry_after(F.col("headers")["retry-after"], F.col("fetched_at")))
    groups = {key: p[2] for v in catalog.values() for key, p in v.probes.items() if p[2]}
    group = F.coalesce(F.col("control_group"), lookup(groups, F.col("probe_key")))
    probes = fetches.where(~is_control()).withColumns({"control_group": group, "retry_after_seconds": limited})
    return early_status(with_validator(probes, catalog), catalog)


def with_fallback(rows: DataFrame, controls: DataFrame) -> DataFrame:
    """Responses still undecided that equal their control become `fallback`.

    Meant for rows without body: only digests take part, so no body is ever shuffled.
    """
    return fallen_back(mark_soft404(rows, controls))


def fallen_back(matched: DataFrame) -> DataFrame:
    """Undecided rows marked with `matches_control` become `fallback`."""
    hit = F.col("status").isNull() & F.col("matches_control")
    return matched.withColumns(
        {
            "status": F.when(hit, "fallback").otherwise(F.col("status")),
            "detail": F.when(hit, "Response matched control-path fallback").otherwise(F.col("detail")),
        }
    ).drop("matches_control")


def prepared(fetches: DataFrame, controls: DataFrame) -> DataFrame:
    """Status of every response as far as it does not take a look into the body (null where it does)."""
    return with_fallback(laddered(fetches).drop("body"), controls)


# fixed values: reasons of unfetched probes
SKIPPED_EARLY = "Skipped after repeated HTTP 429 responses during early discovery probes"
SKIPPED_DISCOVERY = "Skipped after repeated HTTP 429 responses during discovery probes"
SKIPPED_NO_SURFACE = "Skipped after repeated HTTP 429 responses without any valid machine-readable surface"
SKIPPED_NO_HINT = "Skipped because homepage/UCP did not suggest a product catalog"
SKIPPED_NO_CATALOG = "Skipped because no valid public catalog was detected"
SKIPPED_NO_CANDIDATE = "Skipped because no payment probe candidate was discovered"
SKIPPED_TIME = "Skipped after per-domain wall-clock limit was reached before discovery probe fetches completed"


def skip_facts(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """What decides why a probe of a receipt was not fetched, with the probes it does have.

    `stop` is the point where repeated 429 answers without a valid surface ended the receipt (3 on the
    first pass, 5 on later ones): `early` in the cheap probes, `home` with the homepage before any
    discovery probe, `discovery` after that; null when it was not ended that way.
    """
    valid, limited = F.col("status") == "valid", F.col("status") == "rate_limited"
    in_group = lambda names: F.col("probe_key").isin(*names)
    sums = outcomes.groupBy(*keys).agg(
        F.collect_set("probe_key").alias("have"),
        F.count_if(limited & in_group(V.LIGHT_PROBES)).alias("light"),
        F.count_if(limited).alias("all"),
        F.count_if(limited & in_group(["homepage"])).alias("home"),
        F.count_if(in_group(V.DISCOVERY_PROBES)).alias("discovered"),
        F.count_if(valid & ~in_group(V.NON_SURFACE_PROBES)).alias("surfaces"),
        F.count_if(valid & in_group(["products_json", "api_products"])).alias("catalogs"),
    )
    threshold = F.when(F.col("attempt") <= 1, V.RATE_LIMIT_SKIP).otherwise(V.RATE_LIMIT_SKIP_RETRY)
    stop = F.when(
        F.col("surfaces") == 0,
        F.when(F.col("light") >= threshold, "early")
        .when((F.col("discovered") == 0) & ((F.col("home") > 0) | (F.col("all") >= threshold)), "home")
        .when(F.col("all") >= threshold, "discovery"),
    )
    return sums.select(*keys, "have", "catalogs", stop.alias("stop"))


def complete_outcomes(outcomes: DataFrame) -> DataFrame:
    """Every expected probe of a receipt: the fetched ones, and `skipped` rows with the reason.

    Each receipt collects the keys it has (at most the catalogue's twenty) and lists the ones it lacks;
    the catalogue is never joined to the log.
    """
    keys = ["domain", "attempt"]
    expected = F.array(*[F.lit(k) for k in V.EXPECTED_PROBES])
    missing = skip_facts(outcomes, keys).select(*keys, "stop", "catalogs", F.explode(F.array_except(expected, "have")).alias("probe_key"))
    follow_up = F.col("probe_key").isin(*V.FOLLOWUP_PROBES)
    detail = (
        F.when((F.col("stop") == "early") & ~follow_up, SKIPPED_EARLY)
        .when(F.col("stop") == "home", SKIPPED_NO_SURFACE)
        .when(F.col("stop") == "discovery", SKIPPED_DISCOVERY)
        .when(F.col("probe_key") == "products_json", SKIPPED_NO_HINT)
        .when((F.col("probe_key") == "cart_json") & (F.col("catalogs") == 0), SKIPPED_NO_CATALOG)
        .when(F.col("probe_key") == "payment_probe", SKIPPED_NO_CANDIDATE)
        .otherwise(SKIPPED_TIME)
    )
    skipped = missing.select(*keys, "probe_key", F.lit("skipped").alias("status"), detail.alias("detail"))
    return outcomes.unionByName(skipped, allowMissingColumns=True)
