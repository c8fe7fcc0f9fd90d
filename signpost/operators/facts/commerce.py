"""Facts of commerce and shopping-protocol documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions import documents as D
from signpost.functions import text as T
from signpost.functions import urls as U
from signpost.functions.lists import empty_strings, first_by_key, let, merge_all, merge_ordered, non_empty, sorted_distinct
from signpost.functions.stage import compute
from signpost.operators.facts.common import because, finished, judged, starts_json, truncated, was_truncated
from signpost.operators.facts.contracts import doc_hints, has_key, m, parsed, top_keys
from signpost.operators.facts.hints import hint_members, payment_hints, surface_of
from signpost.operators.facts.observed import observed_members, with_observed

OFFER = [
    "id", "offer", "title", "name", "kind", "type", "tier", "status", "price", "priceCurrency", "currency", "unit",
    "interval", "api", "purchase_modes", "offer_lookup_url",
]


def offer_of(o: Column, default_status: Column, checkout_url: Column) -> Column:
    """A sample offer; `o` holds the members of one offer object."""
    price = D.members(o["price"], ["amount", "currency", "interval"])
    flat = F.when(price.isNull(), D.as_text(o["price"]))

    def read(p: Column) -> Column:
        status = F.coalesce(T.status_word(D.as_string(o["status"])), default_status, F.lit("unknown"))
        currency = F.coalesce(D.as_string(p["currency"]), D.as_string(D.first_truthy(o["priceCurrency"], o["currency"])))
        interval = F.coalesce(D.as_string(p["interval"]), D.as_string(D.first_truthy(o["unit"], o["interval"])))
        intent = D.filled(o["api"], "purchase_intent")
        return F.struct(
            D.as_text(D.first_truthy(o["id"], o["offer"])).alias("id"),
            D.as_text(D.first_truthy(o["title"], o["name"])).alias("title"),
            D.as_text(D.first_truthy(o["kind"], o["type"], o["tier"])).alias("kind"),
            status.alias("status"),
            T.blank_to_null(T.strip(F.coalesce(D.as_text(p["amount"]), flat))).alias("amount"),
            F.substring(F.upper(D.filled_text(currency)), 1, 8).alias("currency"),
            F.lower(D.filled_text(interval)).alias("interval"),
            non_empty(F.slice(F.filter(F.transform(D.as_list(o["purchase_modes"]), lambda x: T.strip(D.as_text(x))), lambda x: x != ""), 1, 8)).alias("purchase_modes"),
            intent.alias("purchase_intent_url"),
            F.coalesce(D.filled(o["api"], "offer_lookup"), D.filled_text(D.as_string(o["offer_lookup_url"]))).alias("offer_lookup_url"),
            F.when(intent.isNull(), checkout_url).alias("checkout_url"),
        )

    return let(price, read)


SAMPLE = ["id", "title", "kind", "status", "amount", "currency", "interval", "purchase_modes", "purchase_intent_url", "offer_lookup_url", "checkout_url"]
PATH = ["id", "label", "kind", "status"]


def _live_hints() -> Column:
    """Hints of live machine payment paths, then of live named provider sections."""
    paths = F.filter(
        D.as_list(m("machine_payment_paths")),
        lambda v: T.is_live(D.text_at(v, "status")) & ~T.is_human_checkout(D.text_at(v, "kind")),
    )
    none = F.lit(None).cast("string")
    of_paths = F.transform(paths, lambda v: F.struct(none.alias("name"), v.alias("v")))
    sections = F.filter(
        F.array(*[F.struct(F.lit(n).alias("name"), m(n).alias("v")) for n in V.NAMED_PROVIDER_SECTIONS]),
        lambda x: T.is_live(D.text_at(x["v"], "status")),
    )
    named = F.concat(F.coalesce(of_paths, F.array().cast("array<struct<name:string,v:variant>>")), sections)

    def read(x: Column) -> Column:
        own = F.filter(F.array(x["name"]), lambda n: n.isNotNull())
        return let(payment_hints(D.strings_in(x["v"])), lambda h: h.withField("payment_provider_hints", F.concat(own, h["payment_provider_hints"])))

    return F.transform(named, read)


def commerce_facts(fetches: DataFrame) -> DataFrame:
    names = ["status", "offers", "offerings", "checkout_url", "billing_provider", "auth", "checkout", "machine_payment_paths", "paymentHandlers", *V.NAMED_PROVIDER_SECTIONS]
    docs = parsed(fetches, names)
    text = F.col("text")
    staged = compute(docs, _items=D.list_items(text), _json=T.is_json_type(F.col("content_type")) | starts_json())
    matching = F.size(
        F.filter(F.slice("_items", 1, 20), lambda v: F.coalesce(F.arrays_overlap(F.map_keys(D.as_object(v)), F.array(*[F.lit(k) for k in V.COMMERCE_KEYS])), F.lit(False)))
    )
    counted = compute(staged, _matching=F.when(F.col("_items").isNotNull(), matching))
    is_object, as_json = F.col("_keys").isNotNull(), F.col("_json")
    verdict = judged(
        counted,
        [
            (text == "", "commerce document was empty"),
            (T.is_login_handoff(text), "commerce document looked like a login handoff page"),
            (T.is_error_page(text), "commerce document looked like an error or block page"),
            (as_json & ~is_object & F.col("_items").isNull(), "commerce payload was not an object or list"),
            (as_json & is_object & ~has_key(V.COMMERCE_KEYS), "commerce JSON lacked price or purchase-like keys"),
            (as_json & (F.col("_matching") == 0), "commerce list lacked price or purchase-like objects"),
            (~as_json & (T.is_html_type(F.col("content_type")) | T.is_markup_fragment(text)), "commerce document looked like HTML fallback"),
            (~as_json & ~T.contains_any(F.lower(text), V.COMMERCE_WORDS), "commerce text lacked pricing or purchase language"),
        ],
        F.when(as_json & is_object, "Structured commerce JSON detected").when(as_json, "Structured commerce list detected")
        .otherwise("Commerce text with pricing or purchase language detected"),
    )
    seen = with_observed(verdict, "text", F.col("is_valid") & F.col("_json"))
    first = compute(
        seen,
        _status=T.status_word(D.as_string(m("status"))),
        _checkout=F.when(D.filled_text(D.as_string(m("checkout_url"))).isNotNull(), D.as_string(m("checkout_url"))),
        _billing=D.text_at(m("billing_provider"), "name"),
        _billing_status=T.status_word(D.text_at(m("billing_provider"), "status")),
        _listed=F.when(F.size(D.as_list(m("offers"))) > 0, D.as_list(m("offers"))).otherwise(D.as_list(m("offerings"))),
        _live=_live_hints(),
        _paths=F.filter(
            D.objects(D.as_list(m("machine_payment_paths")), PATH),
            lambda p: T.is_live(D.as_string(p["status"])) & ~T.is_human_checkout(D.as_string(p["kind"])),
        ),
        _handlers=F.filter(F.transform(D.as_list(m("paymentHandlers")), lambda h: T.strip(D.as_text(h))), lambda h: h != ""),
    )
    offers = F.transform(D.objects(F.col("_listed"), OFFER), lambda o: offer_of(o, F.col("_status"), F.col("_checkout")))
    second = compute(first, _offers=F.coalesce(offers, F.array()))
    live = lambda name: merge_all([F.flatten(F.transform("_live", lambda h: h[name]))], 12)
    hinted = compute(
        second,
        _providers=F.coalesce(non_empty(live("payment_provider_hints")), F.when(F.col("_billing") != "", merge_all([F.array("_billing")], 12)), empty_strings()),
        _rails=F.coalesce(non_empty(live("payment_rail_hints")), merge_all([F.col("_handlers")], 12)),
        _hosts=F.coalesce(non_empty(live("payment_endpoint_hosts")), merge_all([F.array(U.host(F.col("_checkout")))], 12)),
        _live_surface=surface_of(live("payment_provider_hints"), live("payment_rail_hints")),
    )
    nonlive_surface = surface_of(merge_all([F.array("_billing")], 12), merge_all([F.col("_handlers")], 12))
    active = F.filter("_offers", lambda o: T.is_active_offer(o["status"]) & ~T.is_prelaunch(o["status"]))
    priced = F.filter("_offers", lambda o: o["amount"].isNotNull() & o["currency"].isNotNull())
    samples = first_by_key(F.col("_offers"), lambda o: F.struct(o["id"], o["title"]), 3)
    member = lambda n, k: merge_ordered(empty_strings(), F.transform("_offers", lambda o: o[n]), k)
    path = lambda n: merge_ordered(empty_strings(), F.transform("_paths", lambda p: D.as_string(p[n])), 12)
    other_rail = F.arrays_overlap("_rails", F.array(*[F.lit(x) for x in ("saved_card", "card", "digital_wallet", "x402")]))
    as_doc = F.col("_json") & is_object
    only = lambda c: F.when(as_doc, c)
    facts = F.struct(
        only(top_keys()).alias("top_level_keys"),
        only(F.col("_status")).alias("commerce_status"),
        only(F.size("_offers")).alias("offer_count"),
        only(F.size(active)).alias("active_offer_count"),
        only(F.size(priced)).alias("priced_offer_count"),
        only(F.transform(samples, lambda o: F.struct(*[o[n].alias(n) for n in SAMPLE]))).alias("sample_offers"),
        F.col("_checkout").alias("checkout_url"),
        only(member("purchase_intent_url", 8)).alias("purchase_intent_urls"),
        only(F.size(member("purchase_intent_url", 8))).alias("purchase_intent_url_count"),
        only(member("offer_lookup_url", 8)).alias("offer_lookup_urls"),
        only(F.size(member("offer_lookup_url", 8))).alias("offer_lookup_url_count"),
        T.status_word(D.text_at(m("auth"), "purchase_intent")).alias("purchase_intent_auth"),
        D.as_text(D.get(m("checkout"), "current_state")).alias("checkout_state"),
        F.col("_billing").alias("billing_provider_name"),
        F.col("_billing_status").alias("billing_provider_status"),
        only(path("id")).alias("live_machine_payment_path_ids"),
        only(path("label")).alias("live_machine_payment_path_labels"),
        only(path("kind")).alias("live_machine_payment_path_kinds"),
        only(F.coalesce(F.size("_paths"), F.lit(0))).alias("live_machine_payment_path_count"),
        only(F.col("_providers")).alias("payment_provider_hints"),
        only(F.col("_rails")).alias("payment_rail_hints"),
        only(F.col("_hosts")).alias("payment_endpoint_hosts"),
        only(F.coalesce("_live_surface", nonlive_surface)).alias("payment_surface"),
        only(F.array_contains("_rails", "crypto") & ~other_rail).alias("crypto_only"),
        only(T.is_prelaunch(F.col("_status")) | T.is_prelaunch(F.col("_billing_status"))).alias("prelaunch"),
        F.when(F.col("_json"), F.size("_items")).alias("item_count"),
        F.when(F.col("_json"), F.col("_matching")).alias("matching_item_count"),
        F.when(~F.col("_json"), F.char_length("text")).alias("char_count"),
        *observed_members(),
    )
    noted = {
        "top_level_keys": because(top_keys(), "commerce JSON lacked price or purchase-like keys"),
        "item_count": because(F.size("_items"), "commerce list lacked price or purchase-like objects"),
        "char_count": because(F.char_length("text"), "commerce text lacked pricing or purchase language"),
    }
    return finished(hinted, facts, rejected=noted)


SERVICE = ["transport", "endpoint"]


def ucp_facts(fetches: DataFrame) -> DataFrame:
    docs = parsed(fetches, ["ucp", "payment"])
    ucp, payment = m("ucp"), m("payment")
    shape = D.members(ucp, ["capabilities", "services", "version", "supported_versions", "payment_handlers"])
    read = compute(docs, _ucp=shape, _strings=F.when(F.col("_keys").isNotNull(), D.strings_of(F.col("text"))))
    u = lambda n: F.col(f"_ucp.{n}")
    shopping = D.get(u("services"), "dev.ucp.shopping")
    listed_names = F.filter(F.transform(D.as_list(u("capabilities")), lambda c: D.as_text(D.first_truthy(D.get(c, "name")))), lambda n: n.isNotNull())
    by_name = F.map_entries(D.as_object(u("payment_handlers")))
    entries_of = lambda v: F.coalesce(D.as_list(v), F.when(D.as_object(v).isNotNull(), F.array(v)), F.array().cast("array<variant>"))
    handlers = F.coalesce(D.list_at(payment, "handlers"), F.array().cast("array<variant>"))
    nested = F.coalesce(F.flatten(F.transform(by_name, lambda e: entries_of(e["value"]))), F.array().cast("array<variant>"))
    opened = compute(
        read,
        _version=D.as_text(D.first_truthy(u("version"))),
        _capabilities=F.coalesce(F.array_sort(F.map_keys(D.as_object(u("capabilities")))), listed_names, empty_strings()),
        _services=F.coalesce(F.size(D.as_object(u("services"))), F.lit(0)),
        _shopping=D.objects(F.coalesce(D.as_list(shopping), F.when(shopping.isNotNull(), F.array(shopping))), SERVICE),
        _handlers=F.filter(F.concat(handlers, nested), lambda h: D.as_object(h).isNotNull()),
        _names=F.concat(
            F.filter(F.transform(handlers, lambda h: D.text_at(h, "name")), lambda n: n != ""),
            F.coalesce(F.filter(F.map_keys(D.as_object(u("payment_handlers"))), lambda n: n != ""), empty_strings()),
        ),
    )
    endpoints = F.filter(F.flatten(F.transform("_handlers", lambda h: D.strings_in(h))), U.is_url_like)
    verdict = judged(
        opened,
        [
            truncated("UCP response"),
            (F.col("text") == "", "empty body"),
            (F.col("_keys").isNull(), "UCP payload was not an object"),
            (F.col("_ucp").isNull(), "UCP payload missing top-level ucp object"),
            (F.col("_version").isNull() & (F.size("_capabilities") == 0) & (F.col("_services") == 0), "UCP payload lacked version, capabilities, and services"),
            (F.exists("_strings", T.is_placeholder), "UCP payload looked like a template or sandbox example"),
        ],
        "Valid UCP document detected",
    )
    seen = with_observed(verdict, "text", F.col("is_valid"))
    hinted = compute(seen, _hints=F.when(F.col("is_valid"), doc_hints()))
    versions = D.as_object(u("supported_versions"))
    current = F.when(F.col("_version").isNotNull(), T.blank_to_null(D.as_string(F.try_element_at(versions, F.col("_version")))))
    mcp = F.transform(F.filter("_shopping", lambda s: D.as_string(s["transport"]) == "mcp"), lambda s: D.as_string(s["endpoint"]))
    ids = F.filter(F.transform("_handlers", lambda h: D.text_at(h, "id")), lambda i: i != "")
    facts_of = {
        "ucp_version": F.col("_version"), "capability_count": F.size("_capabilities"), "service_count": F.col("_services"),
        "payment_handler_count": F.size("_names"), "payment_handler_names": sorted_distinct(F.col("_names"), 12),
    }
    facts = F.struct(
        *[c.alias(n) for n, c in facts_of.items()],
        F.slice("_capabilities", 1, 12).alias("capability_names"),
        sorted_distinct(ids, 12).alias("payment_handler_ids"),
        sorted_distinct(endpoints, 6).alias("payment_endpoint_samples"),
        merge_ordered(empty_strings(), mcp, 8).alias("shopping_mcp_endpoints"),
        current.alias("current_version_url"),
        *observed_members(),
        *hint_members(F.col("_hints")),
    )
    shown = "UCP payload looked like a template or sandbox example"
    noted = {"truncated": was_truncated()} | {n: because(facts_of[n], shown) for n in ("ucp_version", "capability_count", "service_count", "payment_handler_count", "payment_handler_names")}
    return finished(hinted, facts, rejected=noted)
