"""Payment candidates: ranking, choice, and filling of templated addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions import documents as D
from signpost.functions.stage import compute
from signpost.functions.text import blank_to_null, contains_any, strip
from signpost.functions.urls import template_parameters
from signpost.sources.fetches import lookup


def candidate_score(url: Column, title: Column, amount: Column, body_kind: Column, source: Column) -> Column:
    """`body_kind` is `object` for a filled JSON object, `other` for any other body, else null."""
    text = F.lower(F.concat_ws(" ", blank_to_null(url), blank_to_null(title)))
    score = F.lit(0)
    for points, words in V.CANDIDATE_WORD_SCORES:
        score = score + F.when(contains_any(text, words), points).otherwise(0)
    score = score + F.when(amount.isNotNull(), 15).otherwise(0)
    score = score + F.when(body_kind == "object", 10).when(body_kind.isNotNull(), 5).otherwise(0)
    return score + F.coalesce(lookup(V.CANDIDATE_SOURCE_SCORES, source), F.lit(0))


def key_rank(probe_key: Column) -> Column:
    return lookup({k: i for i, k in enumerate(V.CANDIDATE_PROBE_ORDER)}, probe_key)


def scored_candidates(candidates: DataFrame) -> DataFrame:
    """Candidates of the ten documents that may name one, with `score` and `key_rank`."""
    score = candidate_score(*[F.col(c) for c in ("url", "title", "amount", "body_kind", "source")])
    ranked = candidates.withColumns({"score": score, "key_rank": key_rank(F.col("probe_key"))})
    return ranked.where("key_rank IS NOT NULL")


def rank_candidates(candidates: DataFrame, by: list[str]) -> DataFrame:
    """`candidate_rank` per group by score, then probe order, then place in the document.

    A group is one receipt: ten documents name at most six candidates each.
    """
    order = [F.col("score").desc(), F.col("key_rank").asc(), F.col("pos").asc()]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return scored_candidates(candidates).withColumn("candidate_rank", rank.cast("bigint"))


def chosen_candidate(candidates: DataFrame, by: list[str]) -> DataFrame:
    """The first candidate that led to a payment challenge or a free success, else the first one tried."""
    good = F.col("probe_result").isin("payment_challenge", "success_without_payment")
    order = F.struct(
        (~F.coalesce(good, F.lit(False))).cast("int").alias("miss"), (-F.col("score")).alias("s"), F.col("key_rank"), F.col("pos")
    )
    kept = [c for c in candidates.columns if c not in by]
    scored = scored_candidates(candidates)
    return scored.groupBy(*by).agg(F.min_by(F.struct(*kept, "score"), order).alias("c")).select(*by, "c.*")


def example_body(target: Column, method: Column) -> Column:
    """A request body guessed from an action's address, as JSON text; null for methods without one."""
    t = F.lower(F.coalesce(target, F.lit("")))
    # fixed values: example bodies
    guess = (
        F.when(t.contains("/api/submit") | t.endswith("/submit"),
               '{"name":"Sample Service","description":"A service that accepts x402 payments","category":"api","url":"https://example.com/api","protocol":"x402"}')
        .when(t.contains("serp") | t.contains("/search"), '{"q":"openai"}')
        .when(t.contains("scrape"), '{"url":"https://example.com"}')
        .when(t.contains("crawl"), '{"url":"https://example.com","maxPages":1}')
        .when(t.contains("/inbox/") | t.endswith("/inbox"), '{"content":"Test message"}')
        .when(contains_any(t, ["report", "analysis", "chat"]), '{"prompt":"test"}')
        .when(t.contains("subdomain") & t.contains("buy"), '{"subdomain":"sample-name"}')
        .when(t.contains("/send"), '{"to":["hello@example.com"],"subject":"Test subject","text":"Test message"}')
        .otherwise("{}")
    )
    return F.when(F.upper(method).isin("POST", "PUT", "PATCH"), guess)


def body_kind(body: Column) -> Column:
    return F.when(body.isNull(), None).when(body.startswith("{") & (body != "{}"), "object").otherwise("other")


# ------------------------------------------------------------------ templates

WALLET_NAMES = ["btc_address", "btcaddress", "stx_address", "stxaddress", "wallet_address", "wallet", "recipient_address"]


def parameter_name(parameter: Column) -> Column:
    return F.replace(F.lower(strip(parameter)), F.lit("-"), F.lit("_"))


def parameter_aliases(parameter: Column) -> Column:
    """Member names that may hold a parameter, best first."""
    p = parameter_name(parameter)
    id_stem = F.regexp_replace(p, "_id$", "")
    glued_stem = F.regexp_replace(p, "_*id$", "")
    strings = lambda *cs: F.array(*cs)
    extra = F.when(p == "address", F.array(*[F.lit(w) for w in WALLET_NAMES])).when(p == "slug", F.array(F.lit("handle"))).otherwise(F.array().cast("array<string>"))
    derived = (
        F.when(p.endswith("_id"), strings(F.concat(id_stem, F.lit("_id")), id_stem, F.concat(id_stem, F.lit("id"))))
        .when(p.endswith("id") & (p != "id"), strings(p, F.concat(glued_stem, F.lit("_id")), glued_stem))
        .when(p != "id", strings(F.concat(p, F.lit("_id")), F.concat(p, F.lit("id"))))
        .otherwise(F.array().cast("array<string>"))
    )
    names = F.concat(F.array(p), extra, derived, F.array(F.lit("id")))
    return F.array_distinct(F.filter(names, lambda n: n != ""))


def default_parameter(parameter: Column) -> Column:
    p = parameter_name(parameter)
    return F.when(p == "domain", "example.com").when(p.isin("slug", "handle"), "sample-name")


def items_of(text: Column, depth: int = 4) -> Column:
    """Objects of a collection response in document order, at most 25 per list.

    Lists directly below objects are opened, and objects below objects, down to `depth`. Member order
    is kept at the top level; deeper objects list their members by name.
    """

    def head(items: Column) -> Column:
        return F.filter(F.slice(items, 1, 25), lambda v: D.kind(v).startswith("OBJECT"))

    def below(v: Column, level: int) -> Column:
        members = F.map_values(D.as_object(v))
        listed = lambda m: F.coalesce(head(D.as_list(m)), F.array().cast("array<variant>"))
        if level >= depth:
            return F.flatten(F.transform(members, listed))
        return F.flatten(F.transform(members, lambda m: F.when(D.kind(m).startswith("OBJECT"), below(m, level + 1)).otherwise(listed(m))))

    top = F.map_values(F.from_json(text, "map<string,variant>"))
    listed = lambda m: F.coalesce(head(D.as_list(m)), F.array().cast("array<variant>"))
    from_object = F.flatten(F.transform(top, lambda m: F.when(D.kind(m).startswith("OBJECT"), below(m, 2)).otherwise(listed(m))))
    return F.when(D.list_items(text).isNotNull(), head(D.list_items(text))).when(D.is_object(text), from_object)


def member_value(item: Column, parameter: Column) -> Column:
    """Text of the first alias the item has a non-blank string or a number under."""
    members = F.transform(
        F.map_entries(D.as_object(item)),
        lambda e: F.struct(parameter_name(e["key"]).alias("name"), strip(D.as_text(e["value"])).alias("value")),
    )
    usable = F.filter(members, lambda m: m["value"].isNotNull() & (m["value"] != ""))
    found = F.transform(
        parameter_aliases(parameter),
        lambda a: F.get(F.transform(F.filter(usable, lambda m: m["name"] == a), lambda m: m["value"]), F.lit(0)),
    )
    return F.get(F.filter(found, lambda f: f.isNotNull()), F.lit(0))


def fill(template: Column, names: Column, values: Column) -> Column:
    """The template with `{name}` and `/:name` replaced."""
    pairs = F.arrays_zip(names.alias("n"), values.alias("v"))

    def put(text: Column, pair: Column) -> Column:
        braces = F.replace(text, F.concat(F.lit("{"), pair["n"], F.lit("}")), pair["v"])
        colon = F.concat(F.lit("((?<=/)|^):\\Q"), pair["n"], F.lit("\\E(?![a-zA-Z0-9_])"))
        quoted = F.replace(F.replace(pair["v"], F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
        return F.regexp_replace(braces, colon, quoted)

    return F.aggregate(pairs, template, put)


def resolve_templates(candidates: DataFrame, discoveries: DataFrame, by: list[str]) -> DataFrame:
    """Templated candidates filled from captured collection responses.

    candidates: by..., candidate_id, url, discovery_urls (ordered). discoveries: by..., discovery_url,
    http_status, body text. The first item, in order of discovery URL and place, that has every
    parameter fills the address; without discovery URL only the defaults can. Adds `resolved_url`
    (null when it stays open), `sample_title`, `sample_amount`, `sample_currency`; with a column
    `price_lookup_url` also `resolved_price_url`, filled with the same item.
    """
    named = compute(candidates, names=template_parameters(F.col("url")))
    sources = named.select(*by, "candidate_id", "names", F.posexplode("discovery_urls").alias("url_rank", "discovery_url"))
    items = discoveries.where("http_status = 200").select(
        *by, "discovery_url", F.posexplode(items_of(strip(F.col("body")))).alias("item_rank", "item")
    )
    tried = sources.join(items, [*by, "discovery_url"])
    valued = compute(tried, found=F.transform("names", lambda n: member_value(F.col("item"), n)))
    whole = valued.where("NOT exists(found, x -> x IS NULL)")
    title = _first_text("item", ["title", "name", "label", "product_title", "artifact_title"], 120)
    amount, currency = price_of("item")
    pick = F.struct("found", "discovery_url", title.alias("title"), amount.alias("amount"), currency.alias("currency"))
    best = whole.groupBy(*by, "candidate_id").agg(F.min_by(pick, F.struct("url_rank", "item_rank")).alias("hit"))
    joined = named.join(best, [*by, "candidate_id"], "left")
    defaults = F.transform("names", default_parameter)
    chosen = F.when(F.size("discovery_urls") == 0, F.when(~F.exists(defaults, lambda d: d.isNull()), defaults)).otherwise(F.col("hit.found"))
    filled = compute(joined, _chosen=chosen)
    address = F.when(F.size("names") == 0, F.col("url")).when(F.col("_chosen").isNotNull(), fill(F.col("url"), F.col("names"), F.col("_chosen")))
    priced = {}
    if "price_lookup_url" in candidates.columns:
        price_url = F.when(F.col("hit.found").isNotNull(), fill(F.col("price_lookup_url"), F.col("names"), F.col("hit.found")))
        priced["resolved_price_url"] = F.when(F.size(template_parameters(price_url)) == 0, blank_to_null(price_url))
    return filled.withColumns(
        priced | {
            "resolved_url": F.when(F.size(template_parameters(address)) == 0, address),
            "sample_title": F.col("hit.title"),
            "sample_amount": F.col("hit.amount"),
            "sample_currency": F.col("hit.currency"),
            "used_discovery_url": F.col("hit.discovery_url"),
        }
    ).drop("_chosen", "hit", "names")


def price_of(column: str) -> tuple[Column, Column]:
    """(amount, currency) an item or a price answer states, as text."""
    currency = F.upper(_first_text(column, ["currency", "currency_code", "currencyCode", "priceCurrency"], 16))
    pricing_currency = F.upper(_first_text(column, [f"pricing.{k}" for k in ("currency", "currency_code", "currencyCode", "asset", "name")], 16))
    paths = ("price", "amount", "min_price", "max_price", "cost", "pricing.amount", "pricing.price")
    amount = F.coalesce(*[D.as_price(D.get(F.col(column), *k.split("."))) for k in paths])
    return amount_text(amount), F.coalesce(currency, pricing_currency)


def _first_text(column: str, paths: list[str], length: int) -> Column:
    return F.coalesce(*[F.substring(D.filled(F.col(column), *p.split(".")), 1, length) for p in paths])


def amount_text(amount: Column) -> Column:
    """Whole amounts without decimals."""
    return F.when(amount == F.floor(amount), F.floor(amount).cast("string")).otherwise(amount.cast("string"))


# ------------------------------------------------------------------ catalogue answers


def catalog_queries(title: Column) -> Column:
    """Search words to ask a catalogue for: nothing first, then up to three title words.

    A word of the domain only counts when the title has it too, so the domain adds none of its own.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit("[a-z]{4,}"), F.lit(0)))
    asked = F.array_except(words, F.array(*[F.lit(w) for w in V.QUERY_STOPWORDS]))
    return F.concat(F.array(F.lit(None).cast("string")), F.slice(asked, 1, 3))


def catalog_score(facts: Column) -> Column:
    return (
        F.when(F.coalesce(facts["max_price"], F.lit(0.0)) != 0, 100).otherwise(0)
        + F.when(F.coalesce(facts["priced_variant_count"], F.lit(0)) > 0, 50).otherwise(0)
        + F.when(F.coalesce(facts["product_count"], F.lit(0)) > 0, 10).otherwise(0)
        + F.least(F.coalesce(facts["sample_count"], F.lit(0)), F.lit(3)) * 5
    )


GOOD_CATALOG = 150


def best_catalog(answers: DataFrame, by: list[str]) -> DataFrame:
    """The first answer scoring 150 or more in asking order, else the first with the highest score."""
    good = F.col("score") >= GOOD_CATALOG
    order = F.struct(
        F.when(good, 0).otherwise(1).alias("miss"), F.when(good, 0).otherwise(-F.col("score")).alias("s"), F.col("endpoint_rank"), F.col("query_rank")
    )
    kept = [c for c in answers.columns if c not in by]
    return answers.groupBy(*by).agg(F.min_by(F.struct(*kept), order).alias("a")).select(*by, "a.*")
