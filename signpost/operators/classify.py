"""Outcomes of one attempt to a receipt: tags, aggregates, boundaries, label."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions import documents as D
from signpost.functions.lists import merge_all, non_empty
from signpost.functions.stage import compute
from signpost.functions.text import blank_to_null, contains_any, status_word, strip
from signpost.operators.facts.actions import ACTION, samples_of
from signpost.operators.merges import fact, fact_strings, merge_agent_facts
from signpost.operators.scoring import best_outcome, valid_in

CHECKOUT_RESULTS = ["browser_checkout_redirect", "browser_checkout_handoff"]
PAID_RESULTS = ["payment_challenge", "success_without_payment"]
X402_ORDER = ["x402_json", "x402_well_known", "remote_x402"]
HINT_LISTS = ["payment_provider_hints", "payment_rail_hints", "payment_endpoint_hosts"]


def pivot_outcomes(outcomes: DataFrame, keys: list[str], fields: list[str] = V.OUTCOME_MEMBERS, order: str = "pos") -> DataFrame:
    """One row per receipt with `probes`, a struct of outcomes.

    Repeated rows of a probe first combine to the latest one (of equally late ones, the same in every
    run); every probe then is one aggregate of bounded size, so receipts of any multiplicity are merged
    map-side. Rows without a place in `order`, like those of probes that were never fetched, come before
    all others. `crawled_at` is the time of the receipt's last capture, if the rows carry one.
    """
    present = [f for f in fields if f in outcomes.columns]
    ties = [c for c in ("final_url", "body_sha256", "status") if c in outcomes.columns]
    # a struct is ordered like its members, nulls first, and is never null itself
    rank = F.struct(order, *ties)
    last = F.max("fetched_at") if "fetched_at" in outcomes.columns else F.lit(None).cast("timestamp")
    latest = outcomes.groupBy(*keys, "probe_key").agg(F.max_by(F.struct(*present), rank).alias("o"), last.alias("_at"))
    cells = [F.first(F.when(F.col("probe_key") == k, F.col("o")), ignorenulls=True).alias(k) for k in V.PROBE_ORDER]
    wide = latest.groupBy(*keys).agg(*cells, F.max("_at").alias("_at"))
    return wide.select(*keys, F.struct(*V.PROBE_ORDER).alias("probes"), iso_time(F.col("_at")).alias("crawled_at"))


def iso_time(moment: Column) -> Column:
    """Microseconds, with the offset written out; `session.prepare` makes the session's zone UTC."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def outcome(key: str) -> Column:
    return F.col(f"probes.{key}")


def valid(keys: list[str]) -> Column:
    """First valid outcome of the keys, null when none is."""
    return best_outcome(keys, fall_back=False)


def number(o: Column, name: str) -> Column:
    return F.coalesce(D.as_whole(fact(o, name)), F.lit(0).cast("bigint"))


def word(o: Column, name: str) -> Column:
    return blank_to_null(D.as_string(fact(o, name)))


def flag(o: Column, name: str) -> Column:
    return D.truthy(fact(o, name))


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])


def with_documents(receipts: DataFrame) -> DataFrame:
    """The documents the rules look at: `_products`, `_openapi`, `_x402`, `_commerce`, ... (valid ones only)."""
    picked = {
        "_products": valid(["products_json", "api_products"]),
        "_cart": valid(["cart_json"]),
        "_openapi": valid(["openapi_json", "api_openapi_json"]),
        "_commerce": valid(["well_known_commerce"]),
        "_ucp": valid(["well_known_ucp"]),
        "_x402": valid(X402_ORDER),
        "_probe": valid(["payment_probe"]),
        "_agent": merge_agent_facts([valid([k]) for k in V.AGENT_DOCUMENTS]),
        "_result": word(valid(["payment_probe"]), "probe_result"),
    }
    return compute(receipts, **picked)


def x402_actionable() -> Column:
    x = F.col("_x402")
    lists = [F.coalesce(F.size(D.as_list(fact(x, n))) > 0, F.lit(False)) for n in ("sample_actions", "payment_probe_candidates")]
    counts = [number(x, n) > 0 for n in ("accept_count", "resource_url_count", "priced_action_count")]
    return x.isNotNull() & _any([*counts, *lists, flag(x, "payment_required_header_present"), flag(x, "www_authenticate_present")])


def intent_auth() -> Column:
    return status_word(D.as_string(fact(F.col("_commerce"), "purchase_intent_auth")))


def payable_claim() -> Column:
    """The commerce document promises machine payment and an API backs it."""
    c, o = F.col("_commerce"), F.col("_openapi")
    needs_auth = F.coalesce(intent_auth() != "none", F.lit(False))
    contract = (
        (number(c, "live_machine_payment_path_count") > 0) | flag(c, "payment_surface") | flag(c, "payment_provider_hints") | needs_auth
    )
    challenge = (number(o, "payment_required_operation_count") > 0) | (number(o, "payment_signature_header_count") > 0) | needs_auth
    return (
        c.isNotNull() & (number(c, "priced_offer_count") > 0) & (number(c, "purchase_intent_url_count") > 0)
        & contract & challenge & ~flag(c, "prelaunch")
    )


def browser_checkout() -> Column:
    return _any([
        number(F.col("_products"), "checkout_url_count") > 0,
        word(F.col("_commerce"), "checkout_url").isNotNull(),
        F.col("_result").isin(*CHECKOUT_RESULTS),
    ])


def limited_keys() -> Column:
    return F.array_compact(F.array(*[F.when(outcome(k)["status"] == "rate_limited", F.lit(k)) for k in V.PROBE_ORDER]))


def tag_list() -> Column:
    """Sorted distinct tags. Reads the documents and `_actionable`, `_claim`, `_checkout`, `_limited`."""
    result = F.col("_result")
    rules = {
        "shopify_hint": flag(outcome("homepage"), "shopify_hint"),
        "rate_limited": F.size("_limited") > 0,
        "ai_readable": valid_in(["llms_txt", "llms_full_txt"]),
        "catalog_surface": valid_in(["well_known_ucp", "products_json", "api_products"]),
        "callable_surface": valid_in(V.CALLABLE_PROBES) | (F.col("_probe").isNotNull() & ~F.coalesce(result.isin(*CHECKOUT_RESULTS), F.lit(False))),
        "crawl_basics": valid_in(["robots_txt"]) & valid_in(["sitemap_xml"]),
        "browser_checkout_surface": F.col("_checkout"),
        "offer_surface": number(F.col("_commerce"), "priced_offer_count") > 0,
        "prelaunch_offer_surface": flag(F.col("_commerce"), "prelaunch"),
        "machine_payable": F.col("_actionable") | F.col("_claim") | F.coalesce(result.isin(*PAID_RESULTS), F.lit(False)),
        "verified_payment_surface": result.isin(*PAID_RESULTS),
        "free_tier_or_optional_payment": result == "success_without_payment",
    }
    return F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()])))


def label() -> Column:
    has = lambda t: F.array_contains("tags", t)
    return (
        F.when(has("machine_payable"), "machine_payable")
        .when(has("offer_surface"), "offer_surface")
        .when(has("callable_surface"), "callable_surface")
        .when(has("catalog_surface"), "catalog_surface")
        .when(has("ai_readable"), "ai_readable")
        .when(F.size("_limited") > 0, "rate_limited")
        .when(outcome("homepage")["status"] == "error", "unreachable")
        .when(has("crawl_basics"), "crawl_basics_only")
        .otherwise("no_clear_signal")
    )


def purchase_boundary() -> Column:
    result, c = F.col("_result"), F.col("_commerce")
    priced = number(c, "priced_offer_count") > 0
    return (
        F.when(result == "payment_challenge", "payment_challenge")
        .when(result == "success_without_payment", "optional_or_prepaid_payment")
        .when(result.isin(*CHECKOUT_RESULTS), "checkout_redirect")
        .when(result == "auth_or_method_boundary", "auth_boundary")
        .when(result == "input_validation", "input_validation_boundary")
        .when(word(c, "checkout_url").isNotNull(), "checkout_redirect")
        .when(priced & (number(c, "purchase_intent_url_count") > 0), "purchase_intent_documented")
        .when(priced, "offer_documented")
        .when(F.col("_checkout") & (F.col("_products").isNotNull() | c.isNotNull()), "checkout_redirect")
        .when(F.col("_products").isNotNull(), "catalog_only")
        .when(F.array_contains("tags", "ai_readable"), "read_only")
        .when(F.array_contains("tags", "crawl_basics"), "crawl_only")
        .otherwise("unknown")
    )


def control_boundary() -> Column:
    """Reads `payment_surface`, `crypto_only` and `_schemes` besides the documents."""
    result, auth = F.col("_result"), intent_auth()
    surface, crypto = F.col("payment_surface"), F.col("crypto_only")
    token = F.size("_schemes") > 0
    return (
        F.when(auth.isin("wallet", "siwx", "http_signatures"), "wallet_required")
        .when(auth.isin("oauth2", "bearer", "token", "api_key", "apikey", "auth"), "token_required")
        .when(result == "success_without_payment", "none")
        .when(
            result == "payment_challenge",
            F.when(surface == "saved_card_authority", "owner_preauthorized_card").when(crypto, "wallet_required").otherwise("payment_required"),
        )
        .when(result == "auth_or_method_boundary", F.when(crypto, "wallet_required").when(token, "token_required").otherwise("auth_required"))
        .when(result == "input_validation", "input_required")
        .when(surface == "saved_card_authority", "owner_preauthorized_card")
        .when(crypto, "wallet_required")
        .when(token, "token_required")
        .when(F.col("_checkout"), "human_checkout")
        .otherwise("unknown")
    )


def with_payment(receipts: DataFrame) -> DataFrame:
    """Hint lists, surface, crypto flag, samples and priced actions over all payment documents in fixed order."""
    agent = F.col("_agent")
    documents = [F.col(d) for d in ("_commerce", "_ucp", "_x402", "_probe")]
    x402_word = F.when(F.col("_actionable"), F.array(F.lit("x402")))
    lists = {}
    for name in HINT_LISTS:
        parts = [agent[name], *[fact_strings(d, name) for d in documents[:3]]]
        if name != "payment_endpoint_hosts":
            parts.append(x402_word)
        lists[name] = merge_all([*parts, fact_strings(documents[3], name)], 12)
    before_probe = F.coalesce(agent["payment_surface"], *[word(d, "payment_surface") for d in documents[:3]])
    surface = F.when(F.col("_actionable"), F.lit("x402")).otherwise(F.coalesce(before_probe, word(documents[3], "payment_surface")))
    crypto = _any([agent["crypto_only"], *[flag(d, "crypto_only") for d in documents]])
    priced = F.greatest(F.coalesce(agent["priced_action_count"], F.lit(0).cast("bigint")), number(F.col("_x402"), "priced_action_count"))
    return compute(receipts, **lists, payment_surface=surface, crypto_only=crypto, priced_action_count=priced, sample_actions=_samples())


def _actions_of(o: Column) -> Column:
    return F.coalesce(F.try_variant_get(o["facts"], "$.sample_actions", f"array<{ACTION}>"), F.array().cast(f"array<{ACTION}>"))


def agent_samples() -> Column:
    """Sample actions of the agent documents in order, distinct, at most six."""
    return samples_of(F.concat(*[_actions_of(valid([k])) for k in V.AGENT_DOCUMENTS]))


def _samples() -> Column:
    """Sample actions of API, agent, x402 and payment probe documents, distinct, at most six."""
    none = F.array().cast(f"array<{ACTION}>")
    of = _actions_of
    p = F.col("_probe")
    missing = F.lit(None).cast("string")
    own = F.struct(
        word(p, "probe_method").alias("method"), word(p, "probe_url").alias("url"), missing.alias("path"),
        F.coalesce(word(p, "candidate_sample_title"), word(p, "candidate_title")).alias("title"), missing.alias("description"),
        D.as_text(fact(p, "candidate_amount")).alias("amount"), word(p, "candidate_currency").alias("currency"), missing.alias("network"),
        F.lit("payment_probe").alias("source"),
    ).cast(ACTION)
    probe = F.when(F.size(of(p)) > 0, of(p)).when(word(p, "candidate_title").isNotNull() | word(p, "probe_url").isNotNull(), F.array(own)).otherwise(none)
    return samples_of(F.concat(of(F.col("_openapi")), agent_samples(), of(F.col("_x402")), probe))


def catalog_hint(homepage_text: Column, shopify_hint: Column, ucp_valid: Column) -> Column:
    """Whether a product catalogue is worth asking for."""
    return F.coalesce(ucp_valid, F.lit(False)) | F.coalesce(shopify_hint, F.lit(False)) | F.coalesce(contains_any(F.lower(homepage_text), V.SHOP_MARKERS), F.lit(False))


def _copied(o: Column, names: list[str], prefix: str = "") -> list[Column]:
    return [fact(o, n).alias(f"{prefix}{n}") for n in names]


SAMPLE_PRODUCT = [
    "title", "handle", "slug", "sku", "product_type", "product_url", "vendor", "min_price", "max_price",
    "available_variant_count", "variant_count", "requires_shipping", "availability", "currency",
]


def _sample_products() -> Column:
    """Sample products with a shop address from their handle and the catalogue's (else the cart's) currency."""
    p = F.col("_products")
    codes = F.filter(fact_strings(p, "currency_codes"), lambda c: c != "")
    default = F.coalesce(F.get(codes, F.lit(0)), word(F.col("_cart"), "currency"))

    def one(v: Column) -> Column:
        item = D.members(v, SAMPLE_PRODUCT)
        members = {n: item[n] for n in SAMPLE_PRODUCT}
        handle = blank_to_null(D.as_string(item["handle"]))
        shop = F.concat(F.lit("https://"), F.col("domain"), F.lit("/products/"), handle)
        currency = F.coalesce(D.as_string(item["currency"]), F.when(D.as_double(item["min_price"]).isNotNull(), default))
        members["product_url"] = F.coalesce(blank_to_null(D.as_string(item["product_url"])), shop)
        members["currency"] = currency
        return F.struct(*[c.alias(n) for n, c in members.items()])

    return F.transform(D.as_list(fact(p, "sample_products")), one)


def observed_merged() -> list[Column]:
    """Observed facts of all valid outcomes, in probe order, at most 12 each. Reads `_valid_facts`."""
    empty = F.array().cast("array<string>")

    def of(name: str) -> Column:
        lists = F.transform("_valid_facts", lambda f: F.coalesce(F.try_variant_get(f, f"$.{name}", "array<string>"), empty))
        return non_empty(merge_all([F.flatten(lists)], 12)).alias(name)

    return [of(name) for name in V.OBSERVED_KEYS]


def aggregates() -> Column:
    """The aggregates document: copied facts under their prefix, merged payment facts, boundaries."""
    home = outcome("homepage")
    agent = F.col("_agent")
    agent_members = [
        "api_base_url", "service_url", "docs_url", "openapi_url", "x402_url", "x402_urls", "brand_facts_url", "llms_url", "public_endpoint_urls",
        "public_endpoint_count", "product_urls", "docs_urls", "order_urls", "register_urls", "wallet_guides_urls", "payment_protocol",
        "payment_network_names", "payment_chain_ids", "payment_currency_codes", "payment_assets", "recommended_client", "payment_provider_hints",
        "payment_rail_hints", "payment_endpoint_hosts", "payment_surface", "crypto_only", "priced_action_count",
    ]
    any_agent = _any([valid([k]).isNotNull() for k in V.AGENT_DOCUMENTS])
    named = F.size("_limited") > 0
    retry = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(outcome(k)["status"] == "rate_limited", D.as_whole(fact(outcome(k), "retry_after_seconds"))) for k in V.PROBE_ORDER]))))
    some_payment = F.col("payment_surface").isNotNull() | (F.size("payment_provider_hints") > 0) | (F.size("payment_rail_hints") > 0)
    return F.struct(
        strip(word(home, "favicon_url")).alias("favicon_url"),
        strip(word(home, "og_image_url")).alias("og_image_url"),
        F.when(named, F.size("_limited")).alias("rate_limited_probe_count"),
        F.when(named, F.slice("_limited", 1, 16)).alias("rate_limited_probe_keys"),
        F.array_min(retry).alias("rate_limited_retry_after_seconds"),
        non_empty(F.slice(retry, 1, 8)).alias("rate_limited_retry_after_values"),
        *_copied(F.col("_products"), V.PRODUCT_AGGREGATES),
        _sample_products().alias("sample_products"),
        *_copied(F.col("_cart"), V.CART_AGGREGATES, "cart_"),
        *_copied(F.col("_openapi"), V.OPENAPI_AGGREGATES, "openapi_"),
        *[F.when(any_agent, agent[n]).alias(f"agent_{n}") for n in agent_members],
        non_empty(agent_samples()).alias("agent_sample_actions"),
        *_copied(F.col("_commerce"), V.COMMERCE_AGGREGATES, "commerce_"),
        fact(F.col("_commerce"), "sample_offers").alias("sample_offers"),
        *[fact(F.col("_ucp"), n).alias(n if n == "ucp_version" else f"ucp_{n}") for n in V.UCP_AGGREGATES],
        *_copied(F.col("_x402"), V.X402_AGGREGATES, "x402_"),
        *_copied(F.col("_probe"), V.PAYMENT_PROBE_AGGREGATES, "payment_probe_"),
        *observed_merged(),
        non_empty(F.col("sample_actions")).alias("sample_actions"),
        F.when(F.col("priced_action_count") > 0, F.col("priced_action_count")).alias("priced_action_count"),
        *[non_empty(F.col(n)).alias(n) for n in HINT_LISTS],
        F.col("payment_surface").alias("payment_surface"),
        F.when(some_payment, F.col("crypto_only")).alias("crypto_only"),
        F.col("purchase_boundary").alias("purchase_boundary"),
        F.col("control_boundary").alias("control_boundary"),
        F.col("verified_payment_surface").alias("verified_payment_surface"),
    )


def classified(receipts: DataFrame) -> DataFrame:
    """Receipt rows (keys and `probes`) with tags, label, boundaries, payment roll-up and title.

    Everything is computed inside the row; working columns start with an underscore.
    """
    read = with_documents(receipts)
    tested = compute(read, _actionable=x402_actionable(), _claim=payable_claim(), _checkout=browser_checkout(), _limited=limited_keys())
    paid = with_payment(tested)
    schemes = F.filter(fact_strings(F.col("_openapi"), "auth_schemes"), lambda s: s != "")
    tagged = compute(paid, tags=tag_list(), _schemes=schemes)
    return compute(
        tagged,
        label=label(),
        title=word(outcome("homepage"), "title"),
        purchase_boundary=purchase_boundary(),
        control_boundary=control_boundary(),
        verified_payment_surface=F.array_contains("tags", "verified_payment_surface"),
    )


def receipts_of(classified_rows: DataFrame, keep: list[str]) -> DataFrame:
    """Receipt columns of classified rows: (keep..., label, tags, title, aggregates, probes) and the counts W1 compares.

    `aggregates` is a struct, so the retry figures can still be added; `as_document` makes it a variant.
    """
    probes = [outcome(k)["status"] for k in V.PROBE_ORDER]
    found = F.array(*[F.when(outcome(k)["status"] == "valid", outcome(k)["facts"]) for k in V.PROBE_ORDER])
    classified_rows = compute(classified_rows, _valid_facts=F.filter(found, lambda f: f.isNotNull()))
    count = lambda s: reduce(lambda a, b: a + b, [F.coalesce((p == s).cast("int"), F.lit(0)) for p in probes])
    rows = compute(classified_rows, aggregates=aggregates())
    return rows.select(
        *keep, "crawled_at", "label", "tags", "title", "aggregates", "probes", "verified_payment_surface",
        count("valid").alias("valid_count"), count("rate_limited").alias("rate_limited_count"),
        F.col("aggregates.rate_limited_retry_after_seconds").alias("retry_after_seconds"),
    )


def as_document(receipts: DataFrame) -> DataFrame:
    return receipts.withColumn("aggregates", F.to_variant_object("aggregates"))
