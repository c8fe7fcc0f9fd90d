"""Payment hints: which providers and rails the strings of a document name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions.documents import hosts_of
from signpost.functions.lists import let, or_empty, sorted_distinct
from signpost.functions.text import contains_any, strip
from signpost.functions.urls import is_url_like

NO_HINTS = "struct<payment_provider_hints:array<string>,payment_rail_hints:array<string>,payment_endpoint_hosts:array<string>,payment_surface:string,crypto_only:boolean>"
PUNCTUATION = "./:_- "


def marker_in(text: Column, marker: str) -> Column:
    """Literal for markers with punctuation, whole word otherwise. `text` is lower-case."""
    word = marker.lower().strip()
    if any(p in word for p in PUNCTUATION):
        return text.contains(word)
    return text.contains(word) & text.rlike(rf"(?<![a-z0-9])\Q{word}\E(?![a-z0-9])")


def _named(tests: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(tests[n], F.lit(n)) for n in sorted(tests)]))


def surface_of(providers: Column, rails: Column, saved_card_providers: tuple[str, ...] = ()) -> Column:
    has = lambda name: F.array_contains(rails, name)
    saved = reduce(lambda a, b: a | b, [F.array_contains(providers, p) for p in saved_card_providers], has("saved_card"))
    return (
        F.when(has("x402"), "x402")
        .when(saved, "saved_card_authority")
        .when(has("card") | has("digital_wallet"), "standard_checkout")
        .when(has("crypto"), "crypto")
        .when(F.size(providers) > 0, "provider_named")
    )


def payment_hints(
    strings: Column,
    providers: dict[str, list[str]] = V.PROVIDER_MARKERS,
    rails: dict[str, list[str]] = V.RAIL_MARKERS,
    saved_card_providers: tuple[str, ...] = (),
) -> Column:
    """Hints of a document given all its strings. The vocabulary is a small parameter table.

    Strings that are URLs count by host only; all others are searched as one text, joined by line
    breaks so that no marker can match across two of them.
    """

    def read(seen: Column) -> Column:
        text, hosts = seen["text"], seen["hosts"]
        by_host = lambda m: (F.size(hosts) > 0) & F.exists(hosts, lambda h: h.contains(m))

        def provider(markers: list[str]) -> Column:
            tests = [marker_in(text, m) for m in markers] + [by_host(m) for m in markers if "." in m]
            return reduce(lambda a, b: a | b, tests)

        found = F.struct(
            _named({n: provider(ms) for n, ms in providers.items()}).alias("p"),
            _named({n: reduce(lambda a, b: a | b, [marker_in(text, m) for m in ms]) for n, ms in rails.items()}).alias("r"),
        )
        return let(found, lambda f: _hints(f["p"], f["r"], hosts, contains_any(text, V.CRYPTO_WORDS), saved_card_providers))

    cleaned = F.filter(F.transform(or_empty(strings), strip), lambda s: s != "")
    seen = let(
        cleaned,
        lambda ss: F.struct(
            F.lower(F.array_join(F.filter(ss, lambda s: ~is_url_like(s)), "\n")).alias("text"), hosts_of(ss).alias("hosts")
        ),
    )
    return let(seen, read)


def _hints(providers: Column, rails: Column, hosts: Column, crypto_words: Column, saved: tuple[str, ...]) -> Column:
    has = lambda name: F.array_contains(rails, name)
    other_rail = has("card") | has("digital_wallet") | has("saved_card")
    return F.struct(
        F.slice(providers, 1, 12).alias("payment_provider_hints"),
        F.slice(rails, 1, 12).alias("payment_rail_hints"),
        sorted_distinct(hosts, 12).alias("payment_endpoint_hosts"),
        surface_of(providers, rails, saved).alias("payment_surface"),
        ((has("crypto") | (has("x402") & crypto_words)) & ~other_rail).alias("crypto_only"),
    )


HINT_NAMES = ["payment_provider_hints", "payment_rail_hints", "payment_endpoint_hosts", "payment_surface", "crypto_only"]


def hint_members(hints: Column) -> list[Column]:
    return [hints[n].alias(n) for n in HINT_NAMES]


def text_hints(texts: DataFrame, text: str, **vocabulary) -> DataFrame:
    """Hints of plain texts: every line is one string."""
    return texts.withColumn("hints", payment_hints(F.split(text, "\n"), **vocabulary))
