"""Observed payment facts of a JSON document, by the place of a value in it.

The only Python step is a small walk that lists the leaves and member names of a document with
their paths; which of them mean what is decided by path rules in Spark.
"""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from signpost import values as V
from signpost.functions.lists import let
from signpost.functions.stage import compute

STEP = "\x1f"
# fixed values: walk limits
MAX_DEPTH, MAX_CHILDREN = 7, 40
NODE = ArrayType(StructType([StructField(n, StringType()) for n in ("path", "name", "value")]))
# visited before their siblings, as their blocks are read first
FIRST_KEYS = ("capabilities", "payment", "endpoints")


# fixed values: members the rules look at; a node matters when one of them is near its end
RELEVANT = {
    "capabilities", "protocol", "payment_methods", "supported_methods", "supported_assets", "assets", "currencies", "networks",
    "supported_networks", "requirements", "flow", "payment_providers", "providers", "payment_handlers", "handlers", "endpoints",
}


def _walk(value, path, name, depth, out):
    """Strings as (path, raw member name, text); member names as (path of the object + `{}`, '', name)."""
    near = not RELEVANT.isdisjoint(path.rsplit(STEP, 3)[1:])
    if isinstance(value, str):
        if near:
            out.append((path, name, value.strip()))
    elif depth > MAX_DEPTH:
        return
    elif isinstance(value, dict):
        members = list(value.items())[:MAX_CHILDREN]
        for key, child in members:
            named = "{named}" if isinstance(child, dict) and "name" in child else "{}"
            if near:
                out.append((path + STEP + named, "", key.strip()))
        members.sort(key=lambda m: FIRST_KEYS.index(m[0].strip().lower()) if m[0].strip().lower() in FIRST_KEYS else 9)
        for key, child in members:
            _walk(child, path + STEP + key.strip().lower(), key, depth + 1, out)
    elif isinstance(value, list):
        for i, child in enumerate(value[:MAX_CHILDREN]):
            _walk(child, f"{path}{STEP}[{i}]", "", depth + 1, out)


@pandas_udf(NODE)
def json_nodes(texts: pd.Series) -> pd.Series:
    def nodes(text):
        out: list = []
        try:
            _walk(json.loads(text), "", "", 0, out)
        except (ValueError, TypeError, RecursionError):
            return []
        return [{"path": p, "name": n, "value": v} for p, n, v in out if v]

    return texts.map(nodes)


CONTEXT = rf"{STEP}(?:payment|payments|payment_provider|payment_providers|payment_handler|payment_handlers){STEP}(?:.*{STEP})?"
ANYWHERE = rf"^(?:.*)?{STEP}"
IN_LIST = rf"(?:{STEP}\[1?\d\](?:{STEP}(?:name|id|value|method|asset|currency|network))?)?$"
ENTRY = rf"{STEP}(?:\[1?\d\](?:{STEP}name)?|[^{STEP}]+{STEP}name)$"
# fixed values: fact, path pattern, upper-cased
RULES = [
    ("observed_payment_protocols", rf"^.*{CONTEXT}protocol$", True),
    ("observed_payment_methods", rf"{ANYWHERE}(?:payment_methods|supported_methods){IN_LIST}", False),
    ("observed_payment_assets", rf"^.*{CONTEXT}(?:supported_assets|assets|currencies){IN_LIST}", True),
    ("observed_payment_networks", rf"^.*{CONTEXT}(?:networks|supported_networks){IN_LIST}", False),
    ("observed_payment_requirement_keys", rf"^.*{CONTEXT}requirements{STEP}\{{(?:named)?\}}$", False),
    ("observed_payment_flow_types", rf"^.*{CONTEXT}flow{STEP}type$", False),
    ("observed_payment_providers", rf"^(?:.*{CONTEXT}providers|.*{STEP}payment_providers)(?:{ENTRY}|{STEP}\{{\}}$)", False),
    ("observed_payment_handler_names", rf"^(?:.*{CONTEXT}handlers|.*{STEP}payment_handlers)(?:{ENTRY}|{STEP}\{{\}}$)", False),
    ("observed_capability_names", rf"{ANYWHERE}capabilities{STEP}(?:\{{(?:named)?\}}|\[[12]?\d\](?:{STEP}(?:name|id))?)$", False),
]
# what one of stands in every path that the fact's pattern fits
NEEDED = {
    "observed_payment_protocols": [f"{STEP}protocol"], "observed_payment_methods": ["_methods"], "observed_payment_assets": [f"{STEP}assets", "_assets", f"{STEP}currencies"],
    "observed_payment_networks": [f"{STEP}networks", "_networks"], "observed_payment_requirement_keys": [f"{STEP}requirements{STEP}"],
    "observed_payment_flow_types": [f"{STEP}flow{STEP}type"], "observed_payment_providers": [f"{STEP}providers{STEP}", "_providers" + STEP],
    "observed_payment_handler_names": [f"{STEP}handlers{STEP}", "_handlers" + STEP], "observed_capability_names": [f"{STEP}capabilities{STEP}"],
}
ROLES = {
    "observed_catalog_endpoints": ["catalog"],
    "observed_quote_endpoints": ["quote"],
    "observed_checkout_endpoints": ["checkout"],
    "observed_order_status_endpoints": ["order_status", "order-status", "orderstatus", "order status"],
}
ADDRESS_NAMES = ["endpoint", "url", "href", "path"]


def _parent(n: Column) -> Column:
    return F.regexp_replace(n["path"], f"{STEP}[^{STEP}]*$", "")


def _best_named(nodes: Column, names: list[str]) -> Column:
    """Of sibling members keep the first of `names` that is filled; direct values stay."""

    def rank(n: Column) -> Column:
        return F.array_position(F.array(*[F.lit(x) for x in names]), n["name"])

    def best(hits: Column) -> Column:
        return F.filter(hits, lambda n: (rank(n) == 0) | ~F.exists(hits, lambda m: (rank(m) > 0) & (rank(m) < rank(n)) & (_parent(m) == _parent(n))))

    return let(nodes, lambda hits: F.when(F.size(hits) > 1, best(hits)).otherwise(hits))


def observed_values(nodes: Column) -> Column:
    """(fact_key, values) per fact, in document order, not yet merged. A pattern is tried only on paths that hold what it needs."""

    def matching(pattern: str, needed: list[str]) -> Column:
        near = lambda n: reduce(lambda a, b: a | b, [n["path"].contains(x) for x in needed])
        return F.filter(nodes, lambda n: near(n) & n["path"].rlike(pattern))

    def by_rule(fact: str, pattern: str, upper: bool) -> Column:
        hits = matching(pattern, NEEDED[fact])
        if fact == "observed_capability_names":
            hits = _best_named(hits, ["name", "id"])
        found = F.transform(hits, lambda n: F.upper(n["value"]) if upper else n["value"])
        return F.struct(F.lit(fact).alias("fact_key"), found.alias("values"))

    def by_role(fact: str, roles: list[str]) -> Column:
        role = "|".join(roles)
        pattern = rf"{ANYWHERE}endpoints{STEP}(?:{role})(?:{STEP}(?:{'|'.join(ADDRESS_NAMES)}))?$"
        hits = _best_named(matching(pattern, [f"{STEP}endpoints{STEP}{r}" for r in roles]), ADDRESS_NAMES)
        return F.struct(F.lit(fact).alias("fact_key"), F.transform(hits, lambda n: n["value"]).alias("values"))

    return F.array(*[by_rule(*r) for r in RULES], *[by_role(f, r) for f, r in ROLES.items()])


# only documents with a member of one of these names can yield anything; an escaped letter may hide one
TRIGGER = r'"\s*(?:payment(?:s|_methods|_providers?|_handlers?)?|capabilities|endpoints|supported_methods)\s*"\s*:|\\u00'


def with_observed(docs: DataFrame, text: str, when: Column | None = None) -> DataFrame:
    """`_observed`: map of fact key to merged values (at most 12, endpoints 8), empty lists left out.

    Texts that cannot match any rule never reach Python.
    """
    wanted = F.lower(text).rlike(TRIGGER)
    if when is not None:
        wanted = wanted & F.coalesce(when, F.lit(False))
    nodes = docs.withColumn("_nodes", json_nodes(F.when(wanted, F.col(text))))
    def merged(f: Column) -> Column:
        return F.slice(F.array_distinct(f["values"]), 1, F.when(f["fact_key"].endswith("_endpoints"), 8).otherwise(12))

    listed = F.when(F.size("_nodes") > 0, observed_values(F.col("_nodes")))
    facts = F.map_from_entries(
        F.filter(F.transform(listed, lambda f: F.struct(f["fact_key"].alias("key"), merged(f).alias("value"))), lambda e: F.size(e["value"]) > 0)
    )
    return compute(nodes.drop("_observed"), [c for c in nodes.columns if c != "_nodes"], _observed=facts)


def observed_members() -> list[Column]:
    """The observed facts as struct members; absent ones are null."""
    return [F.try_element_at("_observed", F.lit(k)).alias(k) for k in V.OBSERVED_KEYS]


def observed_rows(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Long form: (keep..., fact_key, pos, value)."""
    seen = with_observed(docs, text)
    long = seen.select(*keep, F.explode("_observed").alias("fact_key", "values"))
    return long.select(*keep, "fact_key", F.posexplode("values").alias("pos", "value"))
