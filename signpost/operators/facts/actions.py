"""Action samples and payment candidates named by x402, agent and API documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signpost.functions import documents as D
from signpost.functions import urls as U
from signpost.functions.lists import empty_strings, first_by_key, let, merge_ordered
from signpost.functions.text import blank_to_null, strip
from signpost.operators.candidates import example_body

ACTION = "struct<method:string,url:string,path:string,title:string,description:string,amount:string,currency:string,network:string,source:string>"
CANDIDATE = (
    "struct<url:string,method:string,source:string,body:string,content_type:string,title:string,amount:string,currency:string,"
    "template_parameters:array<string>,discovery_urls:array<string>,price_lookup_url:string>"
)
# what a document says about one action, before cleaning
BASICS = {
    "method": "string", "url": "string", "path": "string", "title": "string", "description": "string", "amount": "string",
    "currency": "string", "network": "string", "source": "string", "candidate": "boolean", "body": "string", "guess": "boolean",
    "media": "string", "templates": "array<string>", "discovery": "array<string>", "price_url": "string",
}
BASIC = "struct<" + ",".join(f"{n}:{t}" for n, t in BASICS.items()) + ">"
METHOD_PREFIX = r"^\s*([A-Z]+)\s+(/.*)$"


def basics(**given) -> Column:
    """One action as a document states it; what is not given is null."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(*[as_column(given.get(n)).cast(t).alias(n) for n, t in BASICS.items()])


def none_yet() -> Column:
    return F.array().cast(f"array<{BASIC}>")


def _text(c: Column, length: int | None = None) -> Column:
    clean = blank_to_null(strip(c))
    return F.substring(clean, 1, length) if length else clean


def entries_of(stated: Column) -> Column:
    """Cleaned samples and payment candidates of stated actions.

    (action, candidate, priced, currency, url) per action; `candidate` is null without an address.
    """

    def clean(b: Column) -> Column:
        return F.struct(
            F.upper(_text(b["method"])).alias("method"), _text(b["url"]).alias("url"), _text(b["path"]).alias("path"),
            _text(b["title"], 120).alias("title"), _text(b["description"], 240).alias("description"), _text(b["amount"]).alias("amount"),
            F.upper(_text(b["currency"], 16)).alias("currency"), _text(b["network"], 48).alias("network"), b["source"].alias("source"),
            b["candidate"].alias("wanted"), b["guess"].alias("guess"), b["body"].alias("body"), b["media"].alias("media"),
            b["templates"].alias("templates"), b["discovery"].alias("discovery"), b["price_url"].alias("price_url"),
        )

    def finish(c: Column) -> Column:
        sample = [c[n].alias(n) for n in ("method", "url")]
        sample.append(F.when(c["url"].isNull(), c["path"]).alias("path"))
        sample += [c[n].alias(n) for n in ("title", "description", "amount", "currency", "network", "source")]
        body = F.when(c["guess"], F.coalesce(c["body"], example_body(F.coalesce(c["url"], c["path"]), c["method"]))).otherwise(c["body"])
        cand = F.struct(
            c["url"].alias("url"), F.coalesce(c["method"], F.lit("GET")).alias("method"), c["source"].alias("source"), body.alias("body"),
            c["media"].alias("content_type"), c["title"].alias("title"), c["amount"].alias("amount"), c["currency"].alias("currency"),
            c["templates"].alias("template_parameters"), c["discovery"].alias("discovery_urls"), c["price_url"].alias("price_lookup_url"),
        )
        return F.struct(
            F.struct(*sample).alias("action"), F.when(c["wanted"] & c["url"].isNotNull(), cand).alias("candidate"),
            c["amount"].isNotNull().alias("priced"), c["currency"].alias("currency"), c["url"].alias("url"), c["network"].alias("network"),
        )

    return F.transform(F.transform(stated, clean), finish)


def method_of(raw: Column) -> Column:
    """The verb of `POST /x`; null when there is none."""
    return blank_to_null(F.regexp_extract(raw, METHOD_PREFIX, 1))


def path_of(raw: Column) -> Column:

    def read(clean: Column) -> Column:
        # an address that starts with a slash states no verb
        return F.when(clean.startswith("/"), clean).when(clean.rlike(METHOD_PREFIX), strip(F.regexp_extract(clean, METHOD_PREFIX, 2))).otherwise(blank_to_null(clean))

    return let(strip(raw), read)


SERVICE = ["url", "resource", "endpoint", "path", "method", "pricing", "price", "amount", "currency", "network", "name", "description"]


def _addressed(stated: Column, base: Column, source: str) -> Column:
    """Raw statements (raw, verb, title, ...) with their address resolved, as basics."""
    return F.transform(
        stated,
        lambda r: basics(
            method=F.coalesce(r["verb"], method_of(strip(r["raw"])), F.lit("POST")), url=U.resolve(base, path_of(r["raw"])), path=path_of(r["raw"]),
            title=r["title"], description=r["description"], amount=r["amount"], currency=r["currency"], network=r["network"], source=source,
            candidate=True, guess=True, media="application/json",
        ),
    )


def _stated(raw: Column, s: Column, amount: Column, currency: Column, network: Column) -> Column:
    return F.struct(
        raw.alias("raw"), D.as_string(s["method"]).alias("verb"), F.coalesce(D.as_string(s["name"]), raw).alias("title"),
        D.as_string(s["description"]).alias("description"), D.as_text(amount).alias("amount"), currency.alias("currency"), network.alias("network"),
    )


def x402_basics(base: Column, services: Column | None, endpoint_map: Column, endpoint_list: Column | None, source: str) -> Column:
    """Statements of a service list, then of an endpoint map or list."""
    none = F.lit(None).cast("string")

    def service(s: Column) -> Column:
        raw = D.as_string(D.first_truthy(s["url"], s["resource"], s["endpoint"], s["path"]))
        amount = F.coalesce(D.first_truthy(D.get(s["pricing"], "amount")), s["price"])
        currency = D.as_string(D.first_truthy(D.get(s["pricing"], "asset"), D.get(s["pricing"], "currency"), s["currency"]))
        return _stated(raw, s, amount, currency, D.as_string(D.first_truthy(D.get(s["pricing"], "network"), s["network"])))

    def endpoint(e: Column) -> Column:
        amount = F.coalesce(D.first_truthy(e["m"]["price"]), e["m"]["amount"])
        return _stated(e["raw"], e["m"], amount, D.as_string(e["m"]["currency"]), none)

    mapped = F.transform(F.map_entries(endpoint_map), lambda e: F.struct(e["key"].alias("raw"), D.members(e["value"], SERVICE).alias("m")))
    found = F.filter(mapped, lambda e: e["m"].isNotNull())
    if endpoint_list is not None:
        listed = F.transform(
            D.objects(endpoint_list, SERVICE),
            lambda m: F.struct(D.filled_text(D.as_string(D.first_truthy(m["path"], m["url"], m["resource"], m["endpoint"]))).alias("raw"), m.alias("m")),
        )
        found = F.coalesce(found, F.filter(listed, lambda e: e["raw"].isNotNull()))
    by_path = F.transform(found, endpoint)
    if services is None:
        stated = by_path
    else:
        of_services = F.transform(D.objects(services, SERVICE), service)
        stated = F.coalesce(F.concat(of_services, by_path), of_services, by_path)
    return F.coalesce(_addressed(stated, base, source), none_yet())


def urls_of(entries: Column, limit: int = 12) -> Column:
    return merge_ordered(empty_strings(), F.transform(entries, lambda e: e["url"]), limit)


def currencies_of(entries: Column, limit: int = 12) -> Column:
    return merge_ordered(empty_strings(), F.transform(entries, lambda e: e["currency"]), limit)


def samples_of(actions: Column, limit: int = 6) -> Column:
    """Distinct on method, address (or path) and title."""
    return first_by_key(actions, lambda a: F.struct(a["method"], F.coalesce(a["url"], a["path"]), a["title"]), limit)


def candidates_of(candidates: Column, limit: int = 6) -> Column:
    """Distinct on method and address."""
    return first_by_key(F.filter(candidates, lambda c: c.isNotNull()), lambda c: F.struct(c["method"], c["url"]), limit)
