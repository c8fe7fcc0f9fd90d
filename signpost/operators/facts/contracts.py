"""Facts of agent, API and x402 documents and of payment probes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions import documents as D
from signpost.functions import text as T
from signpost.functions import urls as U
from signpost.functions.lists import empty_strings, let, merge_all, merge_ordered, non_empty, sorted_distinct
from signpost.functions.stage import compute
from signpost.operators.facts import actions as A
from signpost.operators.facts.common import because, documents, finished, judged, starts_json, truncated, was_truncated
from signpost.operators.facts.hints import HINT_NAMES, NO_HINTS, hint_members, payment_hints
from signpost.operators.facts.observed import observed_members, with_observed
from signpost.operators.facts.texts import title_of


def parsed(fetches: DataFrame, names: list[str]) -> DataFrame:
    """`_keys` (member names in order) and `_doc` (named members) of each JSON object body."""
    docs = compute(documents(fetches), _keys=D.object_keys(F.col("text")))
    return compute(docs, _doc=F.when(F.col("_keys").isNotNull(), D.fields(F.col("text"), names)))


def has_key(names: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap("_keys", F.array(*[F.lit(n) for n in names])), F.lit(False))


def top_keys(keys: str = "_keys") -> Column:
    return F.slice(F.array_sort(keys), 1, 12)


def m(name: str) -> Column:
    return F.col(f"_doc.{name}")


def doc_hints(text: str = "text") -> Column:
    return payment_hints(D.strings_of(F.col(text)))


# ------------------------------------------------------------------ agent cards

ROLE_LEAVES = ["products", "docs", "orders", "register", "wallet_guides"]
# an endpoint that is settled has a path; one whose members are still to be looked at has `below`
ENDPOINT = "struct<name:string,path:string,closed:boolean,below:array<struct<key:string,value:variant>>>"
ENDPOINTS = f"struct<found:array<{ENDPOINT}>,open:boolean>"


def named_endpoints(members: Column, text: Column) -> Column:
    """(dotted name, address, needs auth) of nested endpoint objects and address strings, at any depth.

    Each step opens all members of one level in their places, until none is left to open. A level takes a brace of
    its own, so `text`, which holds the members, has as many braces as there are levels or more.
    """

    def read(name: Column, v: Column) -> Column:
        return let(F.struct(name.alias("name"), v.alias("v"), D.members(v, ["path", "url", "endpoint", "href", "auth"]).alias("o")), settled)

    def settled(x: Column) -> Column:
        o = x["o"]
        own = D.filled_text(D.as_string(D.first_truthy(o["path"], o["url"], o["endpoint"], o["href"])))
        closed = F.when(x["v"].isNotNull(), own.isNotNull() & (D.as_text(o["auth"]) == "True"))
        path = F.coalesce(D.as_string(x["v"]), own)
        return let(path, lambda p: F.struct(
            x["name"].alias("name"), p.alias("path"), closed.alias("closed"), F.when(p.isNull(), F.map_entries(D.as_object(x["v"]))).alias("below")).cast(ENDPOINT))

    def state(level: Column) -> Column:
        kept = F.filter(level, lambda e: e["path"].isNotNull() | e["below"].isNotNull())
        return let(kept, lambda es: F.struct(es.alias("found"), F.coalesce(F.exists(es, lambda e: e["below"].isNotNull()), F.lit(False)).alias("open")).cast(ENDPOINTS))

    def opened(e: Column) -> Column:
        return F.when(e["below"].isNull(), F.array(e)).otherwise(F.transform(e["below"], lambda b: read(F.concat(e["name"], F.lit("."), b["key"]), b["value"])))

    def step(acc: Column, _: Column) -> Column:
        return F.when(acc["open"], state(F.flatten(F.transform(acc["found"], opened)))).otherwise(acc)

    def every(first: Column) -> Column:
        braces = F.char_length(text) - F.char_length(F.replace(text, F.lit("{"), F.lit("")))
        steps = F.when(first["open"], F.sequence(F.lit(0), braces)).otherwise(F.array().cast("array<int>"))
        return F.transform(F.aggregate(steps, first, step)["found"], lambda e: F.struct(e["name"], e["path"], e["closed"]))

    return let(state(F.transform(F.map_entries(members), lambda e: read(e["key"], e["value"]))), every)


def agent_facts(fetches: DataFrame) -> DataFrame:
    names = ["url", "api", "authentication", "auth", "capabilities", "discovery", "documentation", "links",
             "payment", "x402", "skills", "documentationUrl", "openApiUrl"]
    docs = parsed(fetches, names)
    verdict = judged(
        docs,
        [
            truncated("agent response"),
            (F.col("text") == "", "empty body"),
            (F.col("_keys").isNull(), "agent payload was not an object"),
            (~has_key(V.AGENT_KEYS), "agent JSON lacked expected agent-like keys"),
        ],
        "Agent-like JSON detected",
    )
    seen = with_observed(verdict, "text", F.col("is_valid"))
    base = F.col("base")
    # every address the document names, resolved in one go; groups are picked by their place
    groups = {
        "service": [m("url")],
        "api": [D.get(m("api"), "base_url")],
        "docs": [
            D.get(m("api"), "docs"), D.get(m("discovery"), "docs"), m("documentationUrl"), D.get(m("documentation"), "quickStart"),
            D.get(m("documentation"), "fullReference"), D.get(m("links"), "documentation"),
        ],
        "openapi": [
            D.get(m("discovery"), "openapi"), D.get(m("api"), "openapi"), m("openApiUrl"), D.fields(F.col("text"), ["openapiUrl"])["openapiUrl"],
            D.get(m("documentation"), "openApiSpec"), D.get(m("links"), "documentation"),
        ],
        "x402": [D.get(m("discovery"), "x402"), D.get(m("x402"), "url"), D.get(m("x402"), "discovery")],
        "brand": [D.get(m("discovery"), "brand_facts")],
        "llms": [D.get(m("discovery"), "llms_txt")],
    }
    named = [v for vs in groups.values() for v in vs]
    # maps keep the order of the document
    ordered = F.from_json("text", "endpoints map<string,variant>, x402 struct<endpoints map<string,variant>>")
    resolved = compute(
        seen,
        _named=F.transform(F.transform(F.array(*named), D.as_string), lambda v: U.resolve(base, v)),
        _maps=F.when(F.col("is_valid"), ordered),
    )
    place, picks = 0, {}
    for group, values in groups.items():
        picks[f"_{group}"] = F.coalesce(*[F.col("_named")[place + i] for i in range(len(values))])
        place += len(values)
    urls = compute(resolved, **picks, _endpoints=named_endpoints(F.col("_maps.endpoints"), F.col("text")))
    schemes = F.concat(*[F.coalesce(F.transform(D.as_list(v), D.as_string), empty_strings()) for v in (D.get(m("authentication"), "schemes"), D.get(m("auth"), "schemes"))])
    signaled = (
        F.coalesce(F.lower(D.filled(m("payment"), "protocol")) == "x402", F.lit(False))
        | F.exists(schemes, lambda s: F.coalesce(F.lower(T.strip(s)) == "x402", F.lit(False)))
        | (D.truthy(m("x402")) & D.as_object(m("x402")).isNotNull())
    )
    api_or_base = F.coalesce("_api", "base")
    staged = compute(
        urls,
        _opened=F.transform(
            "_endpoints",
            lambda e: F.struct(F.substring_index(e["name"], ".", -1).alias("leaf"), U.resolve_api_path(api_or_base, e["path"]).alias("url"), e["closed"].alias("closed")),
        ),
        _x402_basics=A.x402_basics(base, None, F.col("_maps.x402.endpoints"), None, "agent_x402"),
        _extension_basics=_extension_basics(F.coalesce("_api", "_service", "base")),
        _skill_basics=F.transform(
            D.objects(D.as_list(m("skills")), ["name", "id", "description", "pricing"]),
            lambda s: A.basics(
                title=F.coalesce(D.as_string(s["name"]), D.as_string(s["id"])), description=D.as_string(s["description"]),
                amount=D.as_text(D.get(s["pricing"], "amount")), currency=D.text_at(s["pricing"], "currency"), source="agent_skill", candidate=False,
            ),
        ),
        _networks=D.objects(D.list_at(m("payment"), "networks"), ["name", "chain_id", "currency", "asset"]),
        _x402_urls=merge_all([F.array("_x402"), F.when(signaled, F.array(U.well_known_x402(F.col("_service")), U.well_known_x402(F.col("_api"))))], 8),
        _hints=F.when(F.col("is_valid"), doc_hints()),
    )
    joined = F.concat("_x402_basics", "_extension_basics", F.coalesce("_skill_basics", A.none_yet()))
    every = compute(staged, _every=A.entries_of(joined))
    by_source = lambda source: F.filter("_every", lambda e: e["action"]["source"] == source)
    split = compute(every, _from_x402=by_source("agent_x402"), _from_extension=by_source("agent_extension"), _from_skill=by_source("agent_skill"))
    role = lambda leaf: merge_ordered(empty_strings(), F.transform(F.filter("_opened", lambda e: e["leaf"] == leaf), lambda e: e["url"]), 6)
    open_urls = F.transform(F.filter("_opened", lambda e: ~F.coalesce(e["closed"], F.lit(False))), lambda e: e["url"])
    net = lambda name: F.transform("_networks", lambda n: D.filled_text(D.as_string(n[name])))
    up = lambda xs, n: F.transform(xs, lambda x: F.substring(F.upper(x), 1, n))
    codes = lambda c: F.transform(c, lambda e: F.substring(e["currency"], 1, 12))
    x402_asset = D.text_at(m("x402"), "asset")
    public = merge_all([open_urls, A.urls_of(F.col("_from_x402"))], 12)
    counted = compute(split, _public=public, _docs_role=role("docs"))
    facts = F.struct(
        top_keys().alias("top_level_keys"),
        F.col("_service").alias("service_url"),
        F.col("_api").alias("api_base_url"),
        F.col("_docs").alias("docs_url"),
        F.col("_openapi").alias("openapi_url"),
        F.coalesce("_x402", F.get("_x402_urls", F.lit(0))).alias("x402_url"),
        F.col("_x402_urls").alias("x402_urls"),
        F.col("_brand").alias("brand_facts_url"),
        F.col("_llms").alias("llms_url"),
        F.col("_public").alias("public_endpoint_urls"),
        F.size("_public").alias("public_endpoint_count"),
        role("products").alias("product_urls"),
        F.coalesce(non_empty(F.col("_docs_role")), F.when(F.col("_docs").isNotNull(), F.array("_docs")), empty_strings()).alias("docs_urls"),
        role("orders").alias("order_urls"),
        role("register").alias("register_urls"),
        role("wallet_guides").alias("wallet_guides_urls"),
        D.text_at(m("payment"), "protocol").alias("payment_protocol"),
        merge_all([net("name"), F.array(D.text_at(m("x402"), "network")), F.transform("_from_extension", lambda e: e["network"])], 12).alias("payment_network_names"),
        merge_all([net("chain_id")], 12).alias("payment_chain_ids"),
        merge_all(
            [up(net("currency"), 12), F.array(F.substring(F.upper(x402_asset), 1, 12)), A.currencies_of(F.col("_from_x402")),
             codes(F.col("_from_extension")), codes(F.col("_from_skill"))], 12,
        ).alias("payment_currency_codes"),
        merge_all([net("asset"), F.array(x402_asset)], 12).alias("payment_assets"),
        D.text_at(m("payment"), "recommended_client").alias("recommended_client"),
        A.samples_of(F.transform("_every", lambda e: e["action"])).alias("sample_actions"),
        F.size(F.filter("_every", lambda e: e["priced"])).alias("priced_action_count"),
        A.candidates_of(F.transform("_every", lambda e: e["candidate"])).alias("payment_probe_candidates"),
        *observed_members(),
        *hint_members(F.col("_hints")),
    )
    noted = {"truncated": was_truncated(), "top_level_keys": because(top_keys(), "agent JSON lacked expected agent-like keys")}
    return finished(counted, facts, rejected=noted)


def _extension_basics(base: Column) -> Column:
    """Priced paths of capability extensions; the ones below `/batch` are sent, the others read."""

    def of_extension(x: Column) -> Column:
        params = x["params"]
        prices = F.filter(F.map_entries(D.as_object(D.get(params, "pricing", "endpoints"))), lambda e: T.strip(e["key"]) != "")
        return F.transform(
            prices,
            lambda e: F.struct(
                e["key"].alias("raw"), F.when(F.lower(e["key"]).contains("/batch"), "POST").otherwise("GET").alias("verb"),
                F.when(D.as_object(e["value"]).isNotNull(), D.as_text(D.get(e["value"], "price"))).otherwise(D.as_text(e["value"])).alias("amount"),
                D.text_at(e["value"], "description").alias("about"), D.text_at(params, "currency").alias("currency"), D.text_at(params, "network").alias("network"),
            ),
        )

    def priced(r: Column) -> Column:
        return A.basics(
            method=r["verb"], url=U.resolve_api_path(base, r["raw"]), path=r["raw"], title=U.last_segment(T.strip(r["raw"])), description=r["about"],
            amount=r["amount"], currency=r["currency"], network=r["network"], source="agent_extension", candidate=True, guess=False,
            media="application/json", templates=non_empty(U.template_parameters(r["raw"])),
        )

    extensions = D.objects(D.list_at(m("capabilities"), "extensions"), ["params"])
    stated = F.flatten(F.filter(F.transform(extensions, of_extension), lambda x: x.isNotNull()))
    return F.coalesce(F.transform(stated, priced), A.none_yet())


def agents_facts(fetches: DataFrame) -> DataFrame:
    docs = parsed(fetches, V.AGENTS_LIST_KEYS)
    items = D.list_items(F.col("text"))
    sizes = [F.coalesce(F.size(D.as_list(m(k))), F.lit(0)) for k in V.AGENTS_LIST_KEYS]
    count = F.when(F.col("_keys").isNotNull(), sizes[0] + sizes[1] + sizes[2] + sizes[3]).otherwise(F.size(items))
    verdict = judged(
        docs,
        [
            truncated("agents response"),
            (F.col("text") == "", "empty body"),
            (F.col("_keys").isNull() & items.isNull(), "agents payload was not an object or list"),
            (F.col("_keys").isNotNull() & ~has_key(V.AGENTS_LIST_KEYS), "agents JSON lacked agents/workflows style keys"),
        ],
        F.when(F.col("_keys").isNull(), "Agents/workflows list detected").otherwise("Agents/workflows JSON detected"),
    )
    seen = with_observed(verdict, "text", F.col("is_valid"))
    noted = {"truncated": was_truncated(), "top_level_keys": because(top_keys(), "agents JSON lacked agents/workflows style keys")}
    return finished(seen, F.struct(count.alias("entry_count"), *observed_members()), rejected=noted)


# ------------------------------------------------------------------ API descriptions

OPERATION = ["parameters", "responses", "summary", "operationId", "description"]
OPERATIONS = f"array<struct<pos:int,path:string,place:int,verb:string,paid:boolean,signed:boolean,title:string,description:string>>"


def _signature_header(parameters: Column) -> Column:
    return F.exists(
        D.objects(parameters, ["name", "in"]),
        lambda p: F.coalesce((F.lower(D.as_string(p["in"])) == "header") & (F.lower(D.as_string(p["name"])) == "payment-signature"), F.lit(False)),
    )


def _operations(entry: Column, pos: Column) -> Column:
    """The operations of one path, in the fixed order of methods."""
    item = D.members(entry["value"], ["parameters", *V.OPENAPI_METHODS])
    shared = lambda i: F.coalesce(_signature_header(D.as_list(i["parameters"])), F.lit(False))

    def one(i: Column, place: int, verb: str) -> Column:
        return let(
            D.members(i[verb], OPERATION),
            lambda op: F.when(
                op.isNotNull(),
                F.struct(
                    pos.cast("int").alias("pos"), entry["key"].alias("path"), F.lit(place).alias("place"), F.lit(verb).alias("verb"),
                    D.get(op["responses"], "402").isNotNull().alias("paid"),
                    (shared(i) | F.coalesce(_signature_header(D.as_list(op["parameters"])), F.lit(False))).alias("signed"),
                    F.coalesce(D.as_string(op["summary"]), D.as_string(op["operationId"]), entry["key"]).alias("title"),
                    D.as_string(op["description"]).alias("description"),
                ),
            ),
        )

    return let(item, lambda i: F.filter(F.array(*[one(i, n, verb) for n, verb in enumerate(V.OPENAPI_METHODS)]), lambda o: o.isNotNull()))


def _readable(entries: Column, base: Column) -> Column:
    """Paths that can be read: (path, resolved address, whether identifiers are likely listed there).

    What a path is worth is settled here once, not again for every templated path that looks for listings.
    """

    def read(e: Column) -> Column:
        op = D.members(D.get(e["value"], "get"), ["summary", "operationId", "description"])
        words = F.lower(F.concat_ws(" ", e["key"], D.as_string(op["summary"]), D.as_string(op["operationId"]), D.as_string(op["description"])))
        score = (
            F.when(e["key"].startswith("/api/"), 5).otherwise(0)
            + F.when(T.contains_any(words, V.DISCOVERY_NOUNS), 40).otherwise(0)
            + F.when(T.contains_any(words, V.DISCOVERY_VERBS), 20).otherwise(0)
        )
        likely = (F.size(U.template_parameters(e["key"])) == 0) & (score > 0)
        return F.struct(e["key"].alias("path"), op.isNotNull().alias("readable"), U.resolve_api_path(base, e["key"]).alias("url"), likely.alias("likely"))

    return F.filter(F.transform(entries, read), lambda r: r["readable"])


def _discovery_urls(path: Column, known: Column, likely: Column, base: Column) -> Column:
    """Where a templated path's identifiers may be listed: its collection, else likely listings."""
    stem = F.regexp_replace(F.split_part(path, F.lit("{"), F.lit(1)), "/+$", "")
    others = F.transform(F.filter(likely, lambda r: r["path"] != path), lambda r: r["url"])
    chosen = F.when(F.array_contains(known, stem), F.array(U.resolve_api_path(base, stem))).otherwise(others)
    return merge_ordered(empty_strings(), chosen, 6)


def _price_url(path: Column, known: Column, base: Column) -> Column:
    parent = F.regexp_replace(path, "/[^/]*$", "")
    paths = [F.concat(parent, F.lit(s)) for s in ("/price", "/pricing", "/quote")]
    return U.resolve_api_path(base, F.coalesce(*[F.when(F.array_contains(known, p), p) for p in paths]))


def openapi_facts(fetches: DataFrame) -> DataFrame:
    docs = parsed(fetches, ["openapi", "swagger", "components", "securityDefinitions", "servers"])
    version = D.first_truthy(m("openapi"), m("swagger"))
    servers = F.filter(F.transform(D.as_list(m("servers")), lambda s: D.filled(s, "url")), lambda u: u.isNotNull())
    read = compute(
        docs,
        _version=D.as_text(version),
        _paths=F.map_entries(F.from_json("text", "paths map<string,variant>")["paths"]),
        _server=F.coalesce(F.get(servers, F.lit(0)), F.col("base")),
    )
    verdict = judged(
        read,
        [
            truncated("OpenAPI response"),
            (F.col("text") == "", "empty body"),
            (F.col("_keys").isNull(), "OpenAPI payload was not an object"),
            (F.col("_version").isNull() | F.col("_paths").isNull(), "OpenAPI payload missing version or paths object"),
        ],
        "OpenAPI document detected",
    )
    seen = with_observed(verdict, "text", F.col("is_valid"))
    objects = F.filter("_paths", lambda e: D.members(e["value"], ["get"]).isNotNull())
    counted = compute(seen, _objects=objects)
    opened = compute(
        counted,
        _ops=F.flatten(F.transform("_objects", lambda e, i: _operations(e, i))),
        _readable=_readable(F.col("_objects"), F.col("_server")),
    )
    paid = compute(
        opened, _paid=F.filter("_ops", lambda o: o["paid"]),
        _known=F.transform("_readable", lambda r: r["path"]), _likely=F.filter("_readable", lambda r: r["likely"]),
    )
    base, known, likely = F.col("_server"), F.col("_known"), F.col("_likely")

    def made(o: Column) -> Column:
        names = U.template_parameters(o["path"])
        templated = F.size(names) > 0
        return A.basics(
            method=o["verb"], url=U.resolve_api_path(base, o["path"]), path=o["path"], title=o["title"], description=o["description"], source="openapi",
            candidate=True, guess=True, media="application/json", templates=non_empty(names),
            discovery=F.when(templated, non_empty(_discovery_urls(o["path"], known, likely, base))), price_url=F.when(templated, _price_url(o["path"], known, base)),
        )

    stated = compute(paid, _stated=F.transform("_paid", made))
    built = compute(stated, _made=A.entries_of(F.col("_stated")))
    schemes = F.concat(*[F.coalesce(F.map_keys(D.as_object(v)), empty_strings()) for v in (D.get(m("components"), "securitySchemes"), m("securityDefinitions"))])
    facts = F.struct(
        F.col("_version").alias("openapi_version"),
        F.size("_paths").alias("path_count"),
        sorted_distinct(schemes, 12).alias("auth_schemes"),
        F.size(F.filter("_objects", lambda e: T.contains_any(F.lower(e["key"]), V.OPENAPI_COMMERCE_TOKENS))).alias("commerce_path_count"),
        F.size("_paid").alias("payment_required_operation_count"),
        merge_ordered(empty_strings(), F.transform("_paid", lambda o: F.concat(F.upper(o["verb"]), F.lit(" "), o["path"])), 6).alias("payment_required_paths"),
        F.size(F.filter("_ops", lambda o: o["signed"])).alias("payment_signature_header_count"),
        A.samples_of(F.transform("_made", lambda x: x["action"])).alias("sample_actions"),
        A.candidates_of(F.transform("_made", lambda x: x["candidate"])).alias("payment_probe_candidates"),
        *observed_members(),
    )
    return finished(built, facts, rejected={"truncated": was_truncated()})


# ------------------------------------------------------------------ x402 documents and payment probes


def header(name: str) -> Column:
    return T.blank_to_null(F.try_element_at("headers", F.lit(name)))


def payment_header() -> Column:
    return F.coalesce(header("payment-required"), header("x-payment-required"))


def header_json(value: Column) -> Column:
    """JSON text of a header that is JSON or URL-safe base64 of it; null otherwise."""

    def read(t: Column) -> Column:
        compact = F.regexp_replace(t, "[\n ]", "")
        padded = F.rpad(compact, F.length(compact) + (F.lit(4) - F.length(compact) % 4) % 4, "=")
        decoded = T.strip(T.utf8(F.try_to_binary(F.translate(padded, "-_", "+/"), F.lit("base64"))))
        return F.when(F.substring(t, 1, 1).isin("[", "{"), t).when(F.substring(decoded, 1, 1).isin("[", "{"), decoded)

    return let(let(T.strip(value), read), lambda j: F.when(D.is_object(j) | D.list_items(j).isNotNull(), j))


def with_headers(df: DataFrame) -> DataFrame:
    read = compute(df, _required=payment_header(), _auth=header("www-authenticate"))
    parsed_header = compute(read, _header_json=F.when(F.col("_required").isNotNull(), header_json(F.col("_required"))))
    hints = F.when(F.col("_header_json").isNotNull(), payment_hints(D.strings_of(F.col("_header_json"))))
    return compute(parsed_header, _header_hints=hints.cast(NO_HINTS), _header_keys=F.slice(F.array_sort(D.object_keys(F.col("_header_json"))), 1, 12))


def merged_hints(first: Column, second: Column) -> list[Column]:
    lists = [merge_all([first[n], second[n]], 12).alias(n) for n in HINT_NAMES[:3]]
    surface = F.coalesce(first["payment_surface"], second["payment_surface"]).alias("payment_surface")
    crypto = (F.coalesce(first["crypto_only"], F.lit(False)) | F.coalesce(second["crypto_only"], F.lit(False))).alias("crypto_only")
    return [*lists, surface, crypto]


X402_MEMBERS = ["accepts", "resource", "resources", "services", "endpoints", "extensions", "note", "instructions", "name",
                "statusCode", "status", "type", "message"]
RESOURCE = ["url", "resource", "endpoint", "name", "description", "method"]


def _resource_title(resource: Column, fallback: Column) -> Column:
    """Document name, else resource name, else first sentence of its description, else the address tail."""
    sentence = T.blank_to_null(T.strip(F.split_part(D.filled_text(D.as_string(resource["description"])), F.lit(". "), F.lit(1))))
    own = F.coalesce(F.col("_name"), D.filled_text(D.as_string(resource["name"])), sentence, U.last_segment(T.strip(fallback)))
    return F.substring(own, 1, 120)


def _resource_basics(base: Column) -> Column:
    """Resources given as text (`POST /x`) or as objects; objects without an address drop out."""

    def read(r: Column) -> Column:
        o = D.members(r, RESOURCE)
        return F.struct(D.filled_text(D.as_string(r)).alias("raw"), o.alias("o"))

    def one(x: Column) -> Column:
        o, raw = x["o"], x["raw"]
        address = F.coalesce(*[D.filled_text(D.as_string(o[k])) for k in ("url", "resource", "endpoint")])
        verb = F.coalesce(F.when(raw.isNotNull(), A.method_of(raw)).otherwise(D.as_string(o["method"])), F.lit("POST"))
        return A.basics(
            method=verb, url=F.when(raw.isNotNull(), U.resolve(base, A.path_of(raw))).otherwise(address), path=A.path_of(raw),
            title=F.when(raw.isNotNull(), U.last_segment(A.path_of(raw))).otherwise(_resource_title(o, address)),
            description=D.as_string(o["description"]), source="x402", candidate=raw.isNotNull(), guess=True,
            media=F.when(raw.isNotNull(), "application/json"), templates=None,
        )

    found = F.transform(F.transform("_resources", read), one)
    return F.filter(found, lambda b: b["candidate"] | b["url"].isNotNull())


def _bazaar_basics(base: Column) -> Column:
    """The request a bazaar extension describes; its address falls back to the first resource, then the document."""
    given = D.object_at(m("extensions"), "bazaar", "info", "input")

    def read(pair: Column) -> Column:
        b, first = pair["b"], pair["first"]
        named = F.array(*[D.as_string(b[k]) for k in ("url", "resource", "endpoint", "path")], D.as_string(D.first_truthy(first["url"], first["resource"], first["endpoint"])))
        known = F.filter(F.transform(named, lambda v: U.resolve(base, v)), lambda u: u.isNotNull())
        return let(F.coalesce(F.get(known, F.lit(0)), base), lambda url: built(b, first, url))

    def built(b: Column, first: Column, url: Column) -> Column:
        body_type = D.as_string(b["bodyType"])
        return A.basics(
            method=F.coalesce(D.as_string(b["method"]), F.lit("GET")), url=url, title=_resource_title(first, url), description=D.as_string(first["description"]),
            source="x402", candidate=True, guess=True, body=F.when(b["body"].isNotNull() & (D.kind(b["body"]) != "VOID"), F.to_json(b["body"])),
            media=F.when(body_type.isNull() | (body_type == "json"), "application/json").when(body_type == "text", "text/plain"),
        )

    pair = F.struct(
        D.members(given, ["url", "resource", "endpoint", "path", "method", "body", "bodyType"]).alias("b"),
        D.members(F.get("_resources", F.lit(0)), RESOURCE).alias("first"),
    )
    return F.when(D.truthy(given), F.array(let(pair, read))).otherwise(A.none_yet())


def x402_facts(fetches: DataFrame) -> DataFrame:
    probe_only = "x402 document looked like a probe/example, not a live payment surface"
    with_keys = ["x402 JSON looked like a generic error response", "x402 JSON lacked structured payment evidence", probe_only, "x402 JSON lacked actionable payment surface"]
    noted = {
        "truncated": was_truncated(), "top_level_keys": because(top_keys(), *with_keys), "probe_only": because(F.lit(True), probe_only),
        "item_count": because(F.size("_items"), "x402 list lacked structured payment objects"),
        "char_count": because(F.char_length("text"), "x402 text lacked structured machine-readable evidence"),
    }
    return finished(*_x402_stage(fetches), rejected=noted)


def _x402_stage(fetches: DataFrame) -> tuple[DataFrame, Column]:
    """Judged documents with their working columns, and the facts of a valid one."""
    docs = with_headers(parsed(fetches, X402_MEMBERS))
    text, base = F.col("text"), F.col("base")
    low_keys = F.transform("_keys", lambda k: F.lower(T.strip(k)))
    items = D.list_items(text)
    challenge = (F.col("http_status") == 402) | F.col("_required").isNotNull() | F.col("_auth").isNotNull()
    staged = compute(docs, _low=low_keys, _items=items, _challenge=F.coalesce(challenge, F.lit(False)), _json=T.is_json_type(F.col("content_type")) | starts_json())
    own = D.as_list(m("resources"))
    resources = F.when(D.as_object(m("resource")).isNotNull(), F.concat(F.array(m("resource")), F.coalesce(own, F.array().cast("array<variant>")))).otherwise(own)
    read = compute(
        staged, _accepts=D.as_list(m("accepts")), _resources=F.coalesce(resources, F.array().cast("array<variant>")),
        _map=F.from_json("text", "endpoints map<string,variant>")["endpoints"], _name=D.filled_text(D.as_string(m("name"))),
    )

    def overlap(names: list[str]) -> Column:
        return F.coalesce(F.arrays_overlap("_low", F.array(*[F.lit(n) for n in names])), F.lit(False))

    structured = overlap(V.X402_KEYS + V.X402_DISCOVERY_KEYS) | (F.col("_challenge") & overlap(V.X402_CHALLENGE_KEYS))
    status_text = F.lower(T.strip(D.as_string(m("status"))))
    kind_text, message = F.lower(D.as_string(m("type"))), F.lower(D.as_string(m("message")))
    code = F.when(D.kind(m("statusCode")) == "BIGINT", D.as_whole(m("statusCode")))
    only_error_keys = F.size(F.array_except("_low", F.array(*[F.lit(k) for k in V.X402_ERROR_KEYS]))) == 0
    signs = [
        code >= 400,
        ~F.coalesce(code >= 400, F.lit(False)) & ((status_text.rlike("^[0-9]+$") & (status_text.try_cast("bigint") >= 400)) | status_text.isin("error", "forbidden", "not found", "not_found", "not-found")),
        T.contains_any(kind_text, ["error", "forbidden", "not_found", "not-found"]),
        T.contains_any(message, ["forbidden", "not found", "no route matches", "does not exist"]),
        only_error_keys,
    ]
    error_like = F.lit(False)
    for sign in signs:
        error_like = error_like | F.coalesce(sign, F.lit(False))
    generic_error = ~structured & overlap(V.X402_ERROR_TRIGGERS) & error_like
    note = F.lower(F.coalesce(D.as_string(m("note")), F.lit("")))
    probe_only = (F.coalesce(F.size("_accepts"), F.lit(0)) == 0) & (F.size("_resources") == 0) & T.contains_any(note, V.X402_PROBE_NOTES)

    stated = F.concat(
        A.x402_basics(base, D.as_list(m("services")), F.col("_map"), D.as_list(m("endpoints")), "x402"), _resource_basics(base), _bazaar_basics(base)
    )
    tested = compute(
        read, _structured=structured, _error=generic_error, _probe=probe_only,
        _stated=F.when(F.col("_keys").isNotNull() & structured, stated),
        _matching=F.size(F.filter(F.slice("_items", 1, 20), lambda v: F.coalesce(F.arrays_overlap(
            F.transform(F.map_keys(D.as_object(v)), lambda k: F.lower(T.strip(k))), F.array(*[F.lit(k) for k in V.X402_KEYS + V.X402_LIST_KEYS])), F.lit(False)))),
    )
    tested = compute(tested, _entries=A.entries_of(F.col("_stated")))
    headers_present = F.col("_required").isNotNull() | F.col("_auth").isNotNull()
    actionable = (
        (F.size("_accepts") > 0) | (F.size("_resources") > 0) | (F.size("_entries") > 0) | headers_present
        | (F.col("_challenge") & overlap(V.X402_DISCOVERY_KEYS + V.X402_CHALLENGE_KEYS))
    )
    is_object, is_list = F.col("_keys").isNotNull(), F.coalesce(F.size("_items") > 0, F.lit(False))
    as_json = F.col("_json")
    verdict = judged(
        tested,
        [
            truncated("x402 response"),
            ((text == "") & ~headers_present, "x402 document was empty"),
            ((text != "") & T.is_login_handoff(text), "x402 document looked like a login handoff page"),
            ((text != "") & T.is_error_page(text), "x402 document looked like an error or block page"),
            ((text != "") & as_json & ~is_object & ~is_list, "x402 payload was empty or unsupported"),
            (is_object & F.col("_error"), "x402 JSON looked like a generic error response"),
            (is_object & ~F.col("_structured"), "x402 JSON lacked structured payment evidence"),
            (is_object & F.col("_probe"), "x402 document looked like a probe/example, not a live payment surface"),
            (is_object & ~F.coalesce(actionable, F.lit(False)), "x402 JSON lacked actionable payment surface"),
            (is_list & (F.col("_matching") == 0), "x402 list lacked structured payment objects"),
            ((text != "") & ~as_json & (T.is_html_type(F.col("content_type")) | T.is_markup_fragment(text)), "x402 document looked like HTML fallback"),
            ((text != "") & ~as_json & ~headers_present, "x402 text lacked structured machine-readable evidence"),
        ],
        F.when(is_object, "x402-like JSON detected").when(is_list, "x402-like JSON list detected").otherwise("x402 payment challenge detected from headers"),
    )
    seen = with_observed(verdict, "text", F.col("is_valid") & F.col("_json"))
    hinted = compute(seen, _hints=F.when(F.col("is_valid") & is_object, doc_hints()).cast(NO_HINTS))
    accept = D.objects(F.col("_accepts"), ["network", "asset", "extra"])
    accepted = lambda f: merge_ordered(empty_strings(), F.transform(accept, f), 12)
    named = accepted(lambda a: F.substring(F.upper(D.filled(a["extra"], "name")), 1, 16))
    entries = F.col("_entries")
    facts = F.struct(
        F.when(is_object, top_keys()).alias("top_level_keys"),
        A.urls_of(entries).alias("resource_urls"),
        F.size(A.urls_of(entries)).alias("resource_url_count"),
        F.when(is_object, F.coalesce(F.size("_accepts"), F.lit(0))).alias("accept_count"),
        accepted(lambda a: D.as_string(a["network"])).alias("accept_networks"),
        accepted(lambda a: D.as_string(a["asset"])).alias("accept_assets"),
        F.coalesce(non_empty(named), A.currencies_of(entries)).alias("accept_currencies"),
        F.coalesce(F.char_length(D.as_string(m("instructions"))), F.lit(0)).alias("instructions_char_count"),
        A.samples_of(F.transform(entries, lambda e: e["action"])).alias("sample_actions"),
        F.size(F.filter(entries, lambda e: e["priced"])).alias("priced_action_count"),
        A.candidates_of(F.transform(entries, lambda e: e["candidate"])).alias("payment_probe_candidates"),
        F.col("_required").isNotNull().alias("payment_required_header_present"),
        F.col("_auth").isNotNull().alias("www_authenticate_present"),
        (F.col("text") == "").alias("header_challenge_present"),
        F.when(is_list, F.size("_items")).alias("item_count"),
        F.when(is_list, F.col("_matching")).alias("matching_item_count"),
        F.col("_header_keys").alias("payment_required_header_keys"),
        *merged_hints(F.col("_hints"), F.col("_header_hints")),
        *observed_members(),
    )
    return hinted, facts


def probe_result() -> Column:
    """What a paid request came back with. Reads `_html`, `_target_checkout` and `_redirect_checkout`."""
    code = F.col("http_status")
    return (
        F.when(code == 402, "payment_challenge")
        .when(code.isin(301, 302, 303, 307, 308), F.when(F.col("_redirect_checkout"), "browser_checkout_redirect").otherwise("redirect_boundary"))
        .when((code == 200) & F.col("_html") & F.col("_target_checkout"), "browser_checkout_handoff")
        .when((code == 200) & F.col("_html"), "html_landing_page")
        .when(code == 200, "success_without_payment")
        .when(code.isin(400, 409, 422), "input_validation")
        .when(code.isin(401, 403, 405), "auth_or_method_boundary")
        .when(code.isin(429, 503), "temporary_failure")
        .when(code.isNull() & F.col("error").isNotNull(), "network_error")
    )


PROBE_DETAILS = {
    "payment_challenge": "Payment challenge returned",
    "browser_checkout_redirect": "Action request redirected into a browser checkout flow",
    "browser_checkout_handoff": "Action request reached a browser checkout handoff page",
    "success_without_payment": "Action request succeeded without payment challenge",
    "input_validation": "Action request reached the endpoint but failed input validation",
    "auth_or_method_boundary": "Action request reached the endpoint but hit an auth or method boundary",
    "temporary_failure": "Action request hit a temporary service boundary",
    "redirect_boundary": "Action request redirected before a machine-readable payment boundary could be observed",
    "html_landing_page": "Action request returned an HTML page instead of an API response",
}
PROBE_REJECTED = ["redirect_boundary", "html_landing_page", "network_error"]
CHALLENGE_FACTS = ["resource_urls", "resource_url_count", "accept_count", "accept_networks", "accept_assets", "accept_currencies", "sample_actions", "priced_action_count"]


def payment_probe_facts(fetches: DataFrame) -> DataFrame:
    """Result of a payment probe; a 402 answer with an x402 body also yields that document's facts."""
    document, x402 = _x402_stage(fetches)
    in_challenge = F.col("is_valid") & (F.col("http_status") == 402) & F.col("_keys").isNotNull() & F.col("_json")
    text = F.col("text")
    read = compute(
        document,
        _x402=F.when(in_challenge, x402),
        _auth_hints=F.when(F.col("_auth").isNotNull(), payment_hints(F.array("_auth"))).cast(NO_HINTS),
        _location=T.blank_to_null(T.strip(header("location"))),
        _html=T.is_html_type(F.col("content_type")) | T.is_html_fragment(text) | T.contains_any(F.lower(text), V.HTML_MARKERS[:6]),
        _target_checkout=U.is_checkout_url(F.col("requested_url")) | U.is_checkout_url(F.col("final_url")),
    )
    redirected = U.is_checkout_url(F.col("_location")) | F.col("_target_checkout")
    staged = compute(read, _redirect_checkout=redirected)
    judged_by = compute(staged, _result=probe_result())
    result = F.col("_result")
    rejected = F.when(result == "network_error", F.col("error")).when(
        (result == "html_landing_page") & T.is_error_page(text), "Action request returned an HTML error or block page"
    )
    for name in PROBE_REJECTED[:2]:
        rejected = rejected.when(result == name, PROBE_DETAILS[name])
    unknown = F.concat(F.lit("Unhandled action probe status "), F.coalesce(F.col("http_status").cast("string"), F.lit("None")))
    accepted = F.lit(None).cast("string")
    for name, detail in PROBE_DETAILS.items():
        accepted = F.when(result == name, detail).otherwise(accepted)
    verdict = judged(judged_by, [(result.isin(*PROBE_REJECTED), rejected), (result.isNull(), unknown)], accepted)
    merged = compute(verdict, _header=F.struct(*merged_hints(F.col("_auth_hints"), F.col("_header_hints"))))
    target_host = F.coalesce(U.host(F.col("final_url")), U.host(F.col("requested_url")))
    moved_host = F.coalesce(U.host(F.col("_location")), target_host)
    extra = F.when(result.isin("browser_checkout_redirect", "redirect_boundary"), F.array(moved_host)).when(result == "browser_checkout_handoff", F.array(target_host))
    hosts = merge_ordered(F.col("_header.payment_endpoint_hosts"), extra, 12)
    of_x402 = lambda n: F.col(f"_x402.{n}")
    shown = (text != "") & result.isin("browser_checkout_handoff", "html_landing_page", "success_without_payment", "input_validation", "auth_or_method_boundary", "temporary_failure")
    facts = F.struct(
        F.col("request_method").alias("probe_method"),
        F.col("requested_url").alias("probe_url"),
        F.col("_required").isNotNull().alias("payment_required_header_present"),
        F.col("_auth").isNotNull().alias("www_authenticate_present"),
        F.col("_location").alias("redirect_location"),
        result.alias("probe_result"),
        F.when((F.col("http_status") == 402) & F.col("_json"), top_keys()).alias("response_keys"),
        F.when(shown, F.char_length(text)).alias("response_char_count"),
        F.when(F.col("_html") & result.isin("browser_checkout_handoff", "html_landing_page"), title_of(text)).alias("response_title"),
        F.col("_header_keys").alias("payment_required_header_keys"),
        *[of_x402(n).alias(n) for n in CHALLENGE_FACTS],
        *[F.coalesce(of_x402(n), F.col(f"_header.{n}")).alias(n) for n in HINT_NAMES[:2]],
        F.coalesce(of_x402("payment_endpoint_hosts"), hosts).alias("payment_endpoint_hosts"),
        *[F.coalesce(of_x402(n), F.col(f"_header.{n}")).alias(n) for n in HINT_NAMES[3:]],
    )
    return finished(merged, facts, keep_invalid=True)
