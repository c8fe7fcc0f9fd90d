"""URL parts and relative resolution as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions.lists import let
from signpost.functions.text import blank_to_null, contains_any, strip

# the component split of RFC 3986, appendix B
URL = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
ORIGIN = r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]+)"
ROOTED = r"^/(?:[^/?#][^?#]*)?(?:[?#].*[^?#])?$"
URL_IN_TEXT = r"https?://[^\s<>()\"']+"
URL_TAIL = r"[),.;:!?\]}>\"']+\z"


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, URL, group)


def authority(url: Column) -> Column:
    return F.lower(part(url, 2))


def host(url: Column) -> Column:
    """Lower-cased network location (port included); null when there is none."""
    return blank_to_null(authority(url))


def origin(url: Column) -> Column:
    """`scheme://authority`, null unless both are there."""
    return blank_to_null(F.regexp_extract(url, ORIGIN, 1))


def _tail(query: Column, fragment: Column) -> Column:
    return F.concat(
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )


def _remove_dots(path: Column) -> Column:
    def fold(segments: Column) -> Column:
        kept = F.aggregate(
            segments,
            F.array().cast("array<string>"),
            lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
            .when(s == ".", acc)
            .otherwise(F.concat(acc, F.array(s))),
        )
        ends_on_dots = F.element_at(segments, -1).isin(".", "..")
        return F.array_join(F.when(ends_on_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")

    def folded(p: Column) -> Column:
        return let(fold(F.split(p, "/")), lambda x: F.when(x.startswith("/"), x).otherwise(F.concat(F.lit("/"), x)))

    return let(path, lambda p: F.when(p.contains("/.") | p.startswith("."), F.when(p.rlike(r"(?:^|/)\.\.?(?:/|$)"), folded(p)).otherwise(p)).otherwise(p))


def _join_path(base_path: Column, path: Column) -> Column:
    directory = F.regexp_replace(base_path, r"[^/]*$", "")
    directory = F.when(directory == "", F.lit("/")).otherwise(directory)
    relative = F.regexp_replace(F.concat(directory, path), "/{2,}", "/")
    return _remove_dots(F.when(path.startswith("/"), path).otherwise(relative))


def _parts(url: Column, prefix: str) -> list[Column]:
    """The components of an address; only the scheme is lower-cased."""
    named = {"scheme": F.lower(part(url, 1)), "authority": part(url, 2), "path": part(url, 3), "query": part(url, 4), "fragment": part(url, 5)}
    return [c.alias(prefix + n) for n, c in named.items()]


def resolve(base: Column, candidate: Column) -> Column:
    """Absolute form of `candidate` seen from `base`; null when it is blank or cannot be resolved."""

    def join(c: Column) -> Column:
        return (
            F.when(c.isNull() | (c == ""), None)
            .when(is_url_like(c), c)
            .when(base.isNull() | (base == ""), None)
            .when(c.startswith("/") & is_url_like(base) & ~c.contains("/.") & c.rlike(ROOTED), F.concat(origin(base), c))
            .otherwise(let(F.struct(c.alias("whole"), *_parts(c, ""), *_parts(base, "base_")), general))
        )

    def general(p: Column) -> Column:
        root = F.when(
            p["base_authority"] != "", F.concat(p["base_scheme"], F.lit("://"), p["base_authority"])
        ).otherwise(F.when(p["base_scheme"] != "", F.concat(p["base_scheme"], F.lit(":"))).otherwise(""))
        return (
            F.when((p["scheme"] != "") & (p["scheme"] != p["base_scheme"]), p["whole"])
            .when(p["whole"].startswith("//"), F.concat(p["base_scheme"], F.lit(":"), p["whole"]))
            .when(
                p["path"] == "",
                F.concat(root, p["base_path"], _tail(F.when(p["query"] == "", p["base_query"]).otherwise(p["query"]), p["fragment"])),
            )
            .otherwise(F.concat(root, let(F.struct(p["base_path"].alias("b"), p["path"].alias("p")), lambda x: _join_path(x["b"], x["p"])), _tail(p["query"], p["fragment"])))
        )

    return let(strip(candidate), join)


def only_http(url: Column) -> Column:
    return F.when(url.rlike(r"(?i)^https?://[^/?#]"), url)


def resolve_http(base: Column, candidate: Column) -> Column:
    return let(resolve(base, candidate), only_http)


def resolve_api_path(base: Column, candidate: Column) -> Column:
    """Like `resolve`, but a rooted path is appended to the base path of an API server."""

    def join(c: Column) -> Column:
        return (
            F.when(c.isNull() | (c == ""), None)
            .when(is_url_like(c), c)
            .when(base.isNull() | (base == ""), None)
            .when(~c.startswith("/"), resolve(base, c))
            .otherwise(let(F.struct(c.alias("c"), F.regexp_extract(base, ORIGIN, 1).alias("origin"), F.regexp_replace(part(base, 3), "/+$", "").alias("trimmed")), rooted))
        )

    def rooted(p: Column) -> Column:
        directory = F.when(
            F.regexp_extract(p["trimmed"], r"([^/]*)$", 1).contains("."), F.regexp_replace(p["trimmed"], r"/?[^/]*$", "")
        ).otherwise(p["trimmed"])
        return F.when(p["origin"] != "", resolve(p["origin"], F.concat(directory, p["c"]))).otherwise(resolve(base, p["c"]))

    return let(strip(candidate), join)


def well_known_x402(base: Column) -> Column:
    return F.concat(origin(strip(base)), F.lit("/.well-known/x402.json"))


def urls_in(text: Column) -> Column:
    """Distinct absolute URLs of a text, closing punctuation removed, in order."""
    found = F.regexp_extract_all(text, F.lit(URL_IN_TEXT), F.lit(0))
    return F.array_distinct(F.filter(F.transform(found, lambda u: F.regexp_replace(u, URL_TAIL, "")), lambda u: u != ""))


def is_checkout_url(url: Column) -> Column:
    return F.coalesce(contains_any(F.lower(strip(url)), V.CHECKOUT_URL_MARKERS), F.lit(False))


def is_url_like(c: Column) -> Column:
    return c.startswith("http://") | c.startswith("https://")


def last_segment(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def template_parameters(c: Column) -> Column:
    """Names of `{x}` and `/:x` placeholders, distinct, in order."""
    braces = F.transform(F.regexp_extract_all(c, F.lit(r"\{([^{}]+)\}"), F.lit(1)), strip)
    colons = F.regexp_extract_all(c, F.lit(r"(?:(?<=/)|^):([a-zA-Z_][a-zA-Z0-9_]*)"), F.lit(1))
    return F.coalesce(
        F.array_distinct(F.filter(F.concat(braces, colons), lambda p: p != "")), F.array().cast("array<string>")
    )
