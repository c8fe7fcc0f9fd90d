"""JSON documents: typed access to values whose type is only known at run time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions.lists import let, or_empty
from signpost.functions.text import strip
from signpost.functions.urls import authority, is_url_like

STRING_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"\s*+:?'


# JSON as the reference's parser takes it: NaN and the infinities are numbers, single quotes are none.
# Of members with the same name the last one counts, at any depth: `session.prepare` sees to that.
STRICT = {"allowSingleQuotes": "false"}
_END = "signpost-end"


def value_of(text: Column) -> Column:
    """The JSON value of a whole text as a variant; null when the text is no JSON or goes on after the value.

    The reader stops after the first value, so the text is read as the first of two list items.
    """
    pair = F.from_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')), "array<variant>", STRICT)
    whole = (F.size(pair) == 2) & (F.try_variant_get(F.get(pair, F.lit(1)), "$", "string") == _END)
    return F.when(whole, F.get(pair, F.lit(0)))


def fields(text: Column, names: list[str]) -> Column:
    """The named members of a JSON object, each as a variant; all null when `text` is no object."""
    return F.from_json(text, ", ".join(f"`{n}` variant" for n in names), STRICT)


def object_keys(text: Column) -> Column:
    """Member names in document order; null when `text` is no JSON object."""
    names = F.array_distinct(F.map_keys(F.from_json(text, "map<string,string>", STRICT)))
    return F.when(text.startswith("{") & text.endswith("}") & value_of(text).isNotNull(), names)


def list_items(text: Column) -> Column:
    return F.when(text.startswith("[") & text.endswith("]"), as_list(value_of(text)))


def is_object(text: Column) -> Column:
    return F.coalesce(text.startswith("{") & text.endswith("}") & value_of(text).isNotNull(), F.lit(False))


def get(v: Column, *path: str) -> Column:
    return F.try_variant_get(v, "$" + "".join(f"['{p}']" for p in path), "variant")


def members(v: Column, names: list[str]) -> Column:
    """The named members of an object value as a struct of variants; null for any other value.

    One look at the object instead of one per member, and no type description of the whole value.
    """
    return F.try_variant_get(v, "$", "struct<" + ",".join(f"`{n}`:variant" for n in names) + ">")


def present(members: Column) -> Column:
    """The members of a struct that are not null, by name, as variants."""
    return F.map_filter(as_object(F.to_variant_object(members)), lambda _, v: kind(v) != "VOID")


def objects(items: Column, names: list[str]) -> Column:
    """The named members of every object of a list; other items drop out."""
    return F.filter(F.transform(items, lambda v: members(v, names)), lambda m: m.isNotNull())


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def as_string(v: Column) -> Column:
    """The value when it is a JSON string."""
    return F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def text_at(v: Column, *path: str) -> Column:
    return as_string(get(v, *path))


def filled(v: Column, *path: str) -> Column:
    """Stripped string, null when blank or not a string."""
    return filled_text(text_at(v, *path))


def as_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def list_at(v: Column, *path: str) -> Column:
    return as_list(get(v, *path))


def as_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def object_at(v: Column, *path: str) -> Column:
    """The member when it is an object, as a variant."""
    child = get(v, *path)
    return F.when(as_object(child).isNotNull(), child)


def is_number(v: Column) -> Column:
    return F.coalesce(kind(v).rlike("^(?:BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"), F.lit(False))


def as_double(v: Column) -> Column:
    """Numbers and booleans as DOUBLE; strings and containers are null."""
    return F.when(is_number(v), F.try_variant_get(v, "$", "double"))


def as_whole(v: Column) -> Column:
    """Numbers truncated, booleans 0/1; strings and containers are null."""
    return as_double(v).cast("bigint")


def truthy(v: Column) -> Column:
    """False for null, false, zero and every empty string, list or object."""
    return F.coalesce(~F.to_json(v).isin("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}"), F.lit(False))


def first_truthy(*vs: Column) -> Column:
    return F.coalesce(*[F.when(truthy(v), v) for v in vs])


def as_text(v: Column) -> Column:
    """A scalar the way it prints: 5, 5.0, 9.9, text; null for null and containers."""
    raw = F.try_variant_get(v, "$", "string")
    k = kind(v)
    return (
        F.when(k == "BOOLEAN", F.initcap(raw))
        .when(k.startswith("DECIMAL") & ~raw.contains("."), F.concat(raw, F.lit(".0")))
        .when(k.rlike("^(?:STRING|BIGINT|DECIMAL|DOUBLE)"), raw)
    )


def parse_number(text: Column) -> Column:
    """A price text: thousands commas dropped, plain or exponent notation."""
    t = F.regexp_replace(strip(text), ",", "")
    ok = t.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$") | F.lower(t).rlike(
        r"^[+-]?(?:nan|inf|infinity)$"
    )
    return F.when(ok, t.try_cast("double"))


def as_price(v: Column) -> Column:
    """A number, or a text that reads as one (major units)."""
    return F.when(is_number(v), as_double(v)).otherwise(parse_number(as_string(v)))


def currency_scale(currency: Column) -> Column:
    code = F.substring(F.upper(strip(currency)), 1, 8)
    return (
        F.when(code.isin(*V.ZERO_DECIMAL_CURRENCIES), F.lit(1.0))
        .when(code.isin(*V.THREE_DECIMAL_CURRENCIES), F.lit(1000.0))
        .otherwise(F.lit(100.0))
    )


def money(v: Column) -> Column:
    """(amount, currency) of a price value.

    A numeric `amount` of an object is in minor units; texts and plain numbers are in major units.
    """
    amount_type = "struct<amount:double,currency:string>"

    def in_object(m: Column) -> Column:
        currency = F.when(filled_text(as_string(m["currency"])).isNotNull(), as_string(m["currency"]))
        scale = F.coalesce(currency_scale(currency), F.lit(100.0))
        amount = F.when(is_number(m["amount"]), as_double(m["amount"]) / scale).otherwise(parse_number(as_string(m["amount"])))
        return F.struct(amount.alias("amount"), currency.alias("currency")).cast(amount_type)

    plain = F.struct(as_price(v).alias("amount"), F.lit(None).cast("string").alias("currency")).cast(amount_type)
    return let(members(v, ["amount", "currency"]), lambda m: F.when(m.isNotNull(), in_object(m)).when(v.isNotNull(), plain))


def filled_text(text: Column) -> Column:
    s = strip(text)
    return F.when(s != "", s)


def amount_of(v: Column) -> Column:
    return money(v)["amount"]


def currency_of(v: Column) -> Column:
    return money(v)["currency"]


def strings_of(text: Column) -> Column:
    """Every string value of a JSON text in document order; keys are left out.

    String literals are the only place a quote can stand, so one left-to-right scan splits the
    document; a literal followed by a colon is a key. The JSON reader undoes the escapes.
    """
    tokens = F.regexp_extract_all(text, F.lit(STRING_TOKEN), F.lit(0))
    literals = F.filter(tokens, lambda t: ~t.endswith(":"))
    return or_empty(F.from_json(F.concat(F.lit("["), F.array_join(literals, ","), F.lit("]")), "array<string>"))


def strings_in(v: Column) -> Column:
    return strings_of(F.to_json(v))


def hosts_of(strings: Column) -> Column:
    urls = F.filter(F.transform(strings, strip), is_url_like)
    return F.filter(F.transform(urls, authority), lambda h: h != "")
