"""Facts of HTML and text documents: homepage, robots, sitemap, llms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost import values as V
from signpost.functions import text as T
from signpost.functions import urls as U
from signpost.functions.entities import unescape
from signpost.functions.lists import merge_ordered, non_empty
from signpost.functions.stage import compute
from signpost.operators.facts.common import documents, finished, judged

TITLE = r"(?is)<title[^>]*>(.*?)</title>"
LINK_TAG = r"(?i)<link\b[^>]*>"
META_TAG = r"(?i)<meta\b[^>]*>"
ATTRIBUTE = r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""
# fixed values: tags read, best first
ICON_RELATIONS = [["shortcut", "icon"], ["icon"], ["apple-touch-icon-precomposed"], ["apple-touch-icon"], ["mask-icon"]]
IMAGE_META = [
    ("property", "og:image:secure_url"), ("property", "og:image"),
    ("name", "twitter:image"), ("name", "twitter:image:src"), ("itemprop", "image"),
]
NAMES = [name for _, name in IMAGE_META]


def title_of(text: Column) -> Column:
    return T.blank_to_null(T.collapse(F.regexp_extract(text, TITLE, 1)))


def attributes(tag: Column) -> Column:
    """(names, values) of a tag, in order; character references in values are resolved."""
    names = F.transform(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)), F.lower)
    raw = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2))
    values = F.transform(raw, lambda v: unescape(T.strip(F.regexp_replace(v, r"""(?s)^(["'])(.*)\1$""", "$2"))))
    return F.struct(names.alias("names"), values.alias("values"))


def attribute(parsed: Column, name: str) -> Column:
    """Value of the first attribute of that name; empty when it is missing."""
    at = F.array_position(parsed["names"], name)
    return F.coalesce(F.try_element_at(parsed["values"], F.when(at > 0, at).cast("int")), F.lit(""))


def homepage_facts(fetches: DataFrame) -> DataFrame:
    docs = documents(fetches)
    tags = compute(
        docs,
        _title=title_of(F.col("text")),
        _low=F.lower("text"),
        _links=F.transform(F.regexp_extract_all("text", F.lit(LINK_TAG), F.lit(0)), attributes),
        _metas=F.transform(F.regexp_extract_all("text", F.lit(META_TAG), F.lit(0)), attributes),
    )
    links = F.filter(
        F.transform(
            "_links",
            lambda a: F.struct(
                F.split(F.lower(attribute(a, "rel")), rf"(?U){T.SPACE}+").alias("rel"), attribute(a, "href").alias("href")
            ),
        ),
        lambda x: (x["href"] != "") & ~F.array_contains(x["rel"], ""),
    )
    metas = F.filter(
        F.transform(
            "_metas",
            lambda a: F.struct(
                *[F.lower(attribute(a, n)).alias(n) for n in ("property", "name", "itemprop")], attribute(a, "content").alias("content")
            ),
        ),
        lambda x: x["content"] != "",
    )
    base = F.col("base")
    wanted = ["service-desc", "service-meta", "api-catalog", *{t for ts in ICON_RELATIONS for t in ts}]
    known = compute(
        tags,
        _links=F.filter(links, lambda x: F.arrays_overlap(x["rel"], F.array(*[F.lit(w) for w in wanted]))),
        _metas=F.filter(metas, lambda x: x["property"].isin(*NAMES) | x["name"].isin(*NAMES) | x["itemprop"].isin(*NAMES)),
    )
    opened = compute(
        known,
        _links=F.filter(F.transform("_links", lambda x: x.withField("url", U.resolve_http(base, x["href"]))), lambda x: x["url"].isNotNull()),
        _metas=F.filter(F.transform("_metas", lambda x: x.withField("url", U.resolve_http(base, unescape(T.strip(x["content"]))))), lambda x: x["url"].isNotNull()),
    )

    def by_relation(name: str) -> Column:
        hits = F.filter("_links", lambda x: F.array_contains(x["rel"], name))
        return non_empty(F.array_distinct(F.transform(hits, lambda x: x["url"])))

    def icon(tokens: list[str]) -> Column:
        needed = F.array(*[F.lit(t) for t in tokens])
        return F.get(F.filter("_links", lambda x: F.size(F.array_except(needed, x["rel"])) == 0), F.lit(0))["url"]

    def image(kind: str, name: str) -> Column:
        return F.get(F.filter("_metas", lambda x: x[kind] == name), F.lit(0))["url"]

    facts = F.struct(
        F.col("_title").alias("title"),
        F.col("_low").contains("shopify").alias("shopify_hint"),
        by_relation("service-desc").alias("service_desc_urls"),
        by_relation("service-meta").alias("service_meta_urls"),
        by_relation("api-catalog").alias("api_catalog_urls"),
        F.coalesce(*[icon(t) for t in ICON_RELATIONS]).alias("favicon_url"),
        F.coalesce(*[image(k, n) for k, n in IMAGE_META]).alias("og_image_url"),
    )
    html = T.is_html_type(F.col("content_type")) | F.col("_low").contains("<html") | F.col("_title").isNotNull()
    verdict = judged(
        opened,
        [(F.col("text") == "", "Empty homepage response body"), (~html & ~T.is_text_type(F.col("content_type")), "Homepage did not look like HTML or text")],
        F.when(html, "Fetched homepage HTML").otherwise("Fetched non-HTML homepage text"),
    )
    return finished(verdict, facts, keep_invalid=True)


def robots_facts(fetches: DataFrame) -> DataFrame:
    docs = documents(fetches)
    verdict = judged(
        docs,
        [(F.col("text") == "", "robots.txt was empty"), (~F.lower("text").contains("user-agent"), "robots.txt did not contain a User-agent rule")],
        "Valid robots.txt pattern detected",
    )
    return finished(verdict, F.struct(F.size(T.lines(F.col("text"))).alias("line_count")))


def sitemap_facts(fetches: DataFrame) -> DataFrame:
    docs = compute(documents(fetches), _low=F.lower("text"))
    low = F.col("_low")
    kind = F.when(low.contains("<urlset"), "urlset").when(low.contains("<sitemapindex"), "sitemapindex").when(low.contains("<rss"), "rss").otherwise("xml")
    xml = T.is_xml_type(F.col("content_type")) | low.startswith("<?xml") | low.contains("<urlset") | low.contains("<sitemapindex")
    detail = (
        F.when(kind == "urlset", "Valid sitemap urlset detected").when(kind == "sitemapindex", "Valid sitemap index detected")
        .when(kind == "rss", "RSS/Atom style sitemap detected").otherwise("XML sitemap-like document detected")
    )
    verdict = judged(docs, [(F.col("text") == "", "sitemap.xml was empty"), (~xml, "sitemap.xml did not look like XML")], detail)
    return finished(verdict, F.struct(kind.alias("sitemap_kind")))


def x402_urls(text: Column) -> Column:
    """Discovery URLs a text names, then those derived from lines that mention an API base."""
    named = F.filter(U.urls_in(text), lambda u: F.lower(u).contains("/.well-known/x402"))
    base_lines = F.filter(T.lines(text), lambda line: T.contains_any(F.lower(line), V.API_BASE_MARKERS))
    derived = F.flatten(F.transform(base_lines, lambda line: F.transform(U.urls_in(line), U.well_known_x402)))
    low = F.lower(text)
    marked = low.contains("x402") | low.contains("payment required")
    known = F.filter(derived, lambda u: u.isNotNull())
    return F.when(marked, merge_ordered(F.slice(named, 1, 8), known, 8)).otherwise(F.slice(named, 1, 8))


def llms_facts(fetches: DataFrame) -> DataFrame:
    docs = documents(fetches)
    text = F.col("text")
    verdict = judged(
        docs,
        [
            (text == "", "llms document was empty"),
            (T.is_login_handoff(text), "llms document looked like a login handoff page"),
            (T.is_error_page(text), "llms document looked like an error or block page"),
            (T.is_xml_type(F.col("content_type")) | T.is_markup_fragment(text), "llms document looked like markup fallback"),
        ],
        "Non-empty llms text detected",
    )
    urls = F.when(text.contains("http"), non_empty(x402_urls(text)))
    return finished(verdict, F.struct(F.char_length(text).alias("char_count"), urls.alias("x402_urls")))
