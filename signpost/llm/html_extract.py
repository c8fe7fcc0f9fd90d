"""Main text of web pages: fixed boilerplate rules, then site templates found by counting subtrees per host.

Each page is parsed into the text blocks of its article and the element subtrees over them; a subtree is
known by a hash of its tags and text. Spark counts on how many pages of a host with different main text
a subtree stands. Subtrees on many of them are the site's template, and the blocks under them go. Pages
are parsed once and their blocks stored; page text is never shuffled while the templates of all hosts
are few enough to be sent along, and beyond TEMPLATES_SENT they are joined to the pages instead.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signpost.llm.url_filters import url_parts
from signpost.session import cut, scratch_path, ship_package

MIN_PAGES = 8
MIN_SHARE = 0.3
TEMPLATES_SENT = 4_000_000  # 8 bytes each

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)",
    re.S)
_ATTRIBUTE = re.compile(r"([A-Za-z_:][-A-Za-z0-9_:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile("[a-z]+")
_ROLE_MAIN = re.compile(r"\brole\s*=\s*[\"']?main\b", re.I)

# fixed values: elements by what they do to text
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_DROPPED = frozenset(
    """script style noscript template title head nav footer aside form iframe object embed svg math canvas button select textarea dialog
    menu audio video map noembed noframes""".split())
# fixed values: words in class, id or role that name boilerplate
_NAMED = frozenset(
    """nav navbar navigation menu footer sidebar ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie
    cookies consent gdpr notice popup modal overlay comment comments disqus share sharing social related breadcrumb breadcrumbs newsletter
    subscribe subscription signup login pagination pager widget toolbar complementary contentinfo search dialog alert copyright masthead""".split())
# fixed values: those under which an article element is somebody else's text
_FOREIGN = frozenset("comment comments disqus related".split())
_MAIN = {"main": 1, "article": 2}
_CLOSES = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "option": frozenset({"option"}),
    "tr": frozenset({"tr", "td", "th"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}),
}
_STOPS = {"li": frozenset({"ul", "ol", "menu"}), "dt": frozenset({"dl"}), "dd": frozenset({"dl"}), "tr": frozenset({"table"}), "td": frozenset({"tr", "table"}), "th": frozenset({"tr", "table"})}


@dataclass(slots=True)
class Element:
    tag: str
    named: bool = False  # carries a boilerplate name
    hidden: bool = False
    foreign: bool = False
    main: int = 0  # 1: main element, 2: article
    holds: int = 0  # the highest `main` of itself and its descendants
    parts: list = field(default_factory=list)  # text and elements in order


def _names(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """(named, hidden, foreign) from the attributes of a tag."""
    named = hidden = foreign = False
    if not attributes or tag in ("html", "body", "article", "main"):
        return named, hidden, foreign
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id", "role"):
            words = _WORD.findall(value)
            named |= not _NAMED.isdisjoint(words)
            foreign |= not _FOREIGN.isdisjoint(words)
        hidden |= name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "")
    return named, hidden, foreign


def parse(page: str) -> Element:
    """The element tree of a page; unclosed, misnested and cut off markup is taken as browsers mostly do."""
    root = Element("")
    stack, at, size = [root], 0, len(page)
    while at < size:
        begin = page.find("<", at)
        if begin != at:
            text = page[at:] if begin < 0 else page[at:begin]
            stack[-1].parts.append(entities.unescape(text) if "&" in text else text)
            if begin < 0:
                break
        m = _TAG.match(page, begin)
        if not m:
            stack[-1].parts.append("<")
            at = begin + 1
            continue
        at = m.end()
        closing, name, attributes, closing_, name_, attributes_ = m.groups()
        if not name:
            closing, name, attributes = closing_, name_, attributes_
            if not name or page[at - 1] != ">":
                continue  # a comment or declaration, or a tag that the end of the page cuts off
        tag = name.lower()
        inline = tag in _INLINE
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                above = stack[depth].tag
                if above == tag:
                    del stack[depth:]
                    break
                if inline and above not in _INLINE:
                    break
            continue
        void = tag in _VOID
        if not inline and not void:
            _imply_ends(stack, tag)
        node = Element(tag, *_names(tag, attributes)) if attributes else Element(tag)
        stack[-1].parts.append(node)
        if tag in _RAW:
            end = _raw_end(tag).search(page, at)
            at = end.end() if end else size
        elif not void and attributes[-1:] != "/":
            stack.append(node)
            if tag in _MAIN or attributes and _ROLE_MAIN.search(attributes):
                if not any(above.foreign for above in stack):
                    node.main = _MAIN.get(tag, 1)
                    for above in stack:
                        above.holds = max(above.holds, node.main)
    return root


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(f"</{tag}[^>]*>", re.I)


def _imply_ends(stack: list[Element], tag: str) -> None:
    """Close what the start of `tag` closes by itself: a paragraph before any block, the item before an item."""
    if tag in _CLOSES:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in _STOPS.get(tag, ()):
                break
            if stack[depth].tag in _CLOSES[tag]:
                del stack[depth:]
                break
    elif tag not in _RAW:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag == "p":
                del stack[depth:]
                break
            if stack[depth].tag not in _INLINE:
                break


def _dropped(node: Element, inside: bool) -> bool:
    """Boilerplate by tag, name or state; a page header only outside the article. What holds the article stays."""
    if node.tag in _DROPPED and node.tag not in ("form", "aside", "dialog"):
        return True
    if node.holds:
        return False
    return node.hidden or node.named or node.tag in _DROPPED or node.tag == "header" and not inside


def _articles(node: Element, level: int) -> list[Element]:
    """The outermost elements of `level` that are no boilerplate."""
    found = []
    for part in node.parts:
        if isinstance(part, Element) and part.holds >= level and not (part.tag in _DROPPED and part.tag not in ("form", "aside", "dialog")):
            found += [part] if part.main == level else _articles(part, level)
    return found


def _size(node: Element) -> int:
    """Characters of the text in a node that no rule drops, white space aside."""
    size, open_ = 0, [node]
    while open_:
        for part in open_.pop().parts:
            if isinstance(part, str):
                size += len("".join(part.split()))
            elif not _dropped(part, True):
                open_.append(part)
    return size


def _starts(node: Element) -> list[Element]:
    """Main elements and the articles outside them; in place of a main element its articles, if they hold half of its text."""
    found = []
    for part in node.parts:
        if isinstance(part, Element) and part.holds and not (part.tag in _DROPPED and part.tag not in ("form", "aside", "dialog")):
            inner = _articles(part, 2) if part.main == 1 else []
            if inner and 2 * sum(map(_size, inner)) >= _size(part):
                found += inner
            else:
                found += [part] if part.main else _starts(part)
    return found


def page_blocks(page: str | None) -> tuple[list[str], list[tuple[int, int, int]]]:
    """(blocks, subtrees): the text blocks of the article in page order, and (first, last, hash) of the subtrees over them."""
    root = parse(page or "")
    level = root.holds
    starts = _starts(root) if level else [root]
    blocks: list[str] = []
    subtrees: dict[tuple[int, int], int] = {}
    pending: list[str] = []

    def flush() -> None:
        text = " ".join("".join(pending).split())
        pending.clear()
        if text:
            blocks.append(text)

    # explicit stack: pages may nest deeper than Python recurses
    for start in starts or [root]:
        flush()
        frames = [(start, iter(start.parts), 0, [start.tag])]
        while frames:
            node, parts, first, shape = frames[-1]
            part = next(parts, None)
            if part is None:
                frames.pop()
                if node.tag not in _INLINE:
                    flush()
                    if len(blocks) > first:
                        # an outer element over the same blocks comes later and takes the place
                        subtrees[first, len(blocks) - 1] = xxhash.xxh64_intdigest("\x1f".join([*shape, *blocks[first:]]))
                if frames:
                    frames[-1][3].extend((*shape, "/"))
            elif isinstance(part, str):
                pending.append(part)
            elif _dropped(part, bool(level)):
                if part.tag not in _INLINE:
                    flush()
            elif part.tag == "br":
                pending.append(" ")
            elif part.tag in _VOID:
                if part.tag == "hr":
                    flush()
            else:
                if part.tag not in _INLINE:
                    flush()
                frames.append((part, iter(part.parts), len(blocks), [part.tag]))
    flush()
    whole = sum(map(len, blocks))
    # what holds most of the text is the page itself, however often it is copied
    return blocks, [(a, b, h) for (a, b), h in subtrees.items() if 2 * sum(map(len, blocks[a : b + 1])) <= whole]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _at_host(host: str, subtree: int) -> int:
    return _signed(xxhash.xxh64_intdigest(f"{subtree:x} {host}"))


def read_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, lines, firsts, lasts, subtrees), stored in the shared folder: each page is parsed once.

    lines: the blocks, one a line. subtrees: hashes of (subtree, host) over the blocks firsts to lasts.
    """
    spark = pages.sparkSession
    ship_package(spark)

    @F.pandas_udf("lines string, firsts array<int>, lasts array<int>, subtrees array<long>")
    def parsed(html: pd.Series, hosts: pd.Series) -> pd.DataFrame:
        rows = []
        for page, host in zip(html, hosts, strict=True):
            blocks, found = page_blocks(page)
            rows.append(("\n".join(blocks), [a for a, _, _ in found], [b for _, b, _ in found], [_at_host(host, h) for _, _, h in found]))
        return pd.DataFrame(rows, columns=["lines", "firsts", "lasts", "subtrees"])

    path = scratch_path(spark, "blocks")
    read = pages.select("page_id", "url", "html", url_parts(F.col("url"))[0].alias("host"))
    read.select("page_id", "url", "host", parsed("html", "host").alias("p")).select("page_id", "url", "host", "p.*").write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def templates(read: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(subtree): hashes that stand on at least `min_pages` pages and `min_share` of all pages of their host.

    Pages of a host with the same main text count once, so copies of an article make no template.
    """
    text = F.xxhash64("lines").alias("text")
    # one row for each main text and markup of it: pages of equal text may have other subtrees
    seen = cut(read.groupBy("host", text, F.xxhash64("subtrees").alias("markup")).agg(F.first("subtrees").alias("subtrees")))
    totals = seen.select("host", "text").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("_all"))
    found = seen.select("host", "text", F.explode(F.array_distinct("subtrees")).alias("subtree")).distinct()
    counts = found.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("_pages")).filter(F.col("_pages") >= min_pages)
    return counts.join(totals, "host").filter(F.col("_pages") >= min_share * F.col("_all")).select("subtree")


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, sent: int = TEMPLATES_SENT) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of `pages` (page_id, url, html); text is empty if there is none.

    Null pages are empty. Pages without a url share the empty host. Repeated rows come out as they come in.
    """
    read = read_pages(pages)
    found = cut(templates(read, min_pages, min_share))
    marked = _marked_by_join(read, found) if found.count() > sent else _marked(read, found)
    kept = F.array_join(F.filter(F.split("lines", "\n"), lambda _, i: ~F.array_contains("_gone", i)), " ")
    text = F.when(F.size("_gone") == 0, F.translate("lines", "\n", " ")).otherwise(kept)
    return marked.select("page_id", "url", text.alias("text")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def _marked(read: DataFrame, found: DataFrame) -> DataFrame:
    """`read` with `_gone`, the numbers of the blocks under a template; the templates go to every task."""
    known = read.sparkSession.sparkContext.broadcast(np.sort(found.toArrow()["subtree"].to_numpy()))

    @F.pandas_udf("array<boolean>")
    def on_list(subtrees: pd.Series) -> pd.Series:
        if subtrees.empty:
            return pd.Series([], dtype=object)
        there = np.isin(np.concatenate([np.asarray(s, dtype=np.int64) for s in subtrees]), known.value)
        return pd.Series(np.split(there, np.cumsum([len(s) for s in subtrees])[:-1]), dtype=object)

    spans = F.arrays_zip("firsts", "lasts", on_list("subtrees").alias("on"))
    gone = F.flatten(F.transform(F.filter(spans, lambda s: s["on"]), lambda s: F.sequence(s["firsts"], s["lasts"])))
    return read.withColumn("_gone", gone)


def _marked_by_join(read: DataFrame, found: DataFrame) -> DataFrame:
    """The same without sending the templates: joined to the subtrees, and the hits to the pages by host, text and markup."""
    markup = F.to_json(F.struct("firsts", "lasts", "subtrees"))
    keyed = read.withColumn("_key", F.sha2(F.concat_ws("\n", "host", "lines", markup), 256))
    spots = keyed.select("_key", F.inline(F.arrays_zip("firsts", "lasts", "subtrees"))).distinct()
    gone = spots.join(found, F.col("subtrees") == F.col("subtree")).groupBy("_key").agg(
        F.flatten(F.collect_list(F.sequence("firsts", "lasts"))).alias("_gone"))
    return keyed.join(gone, "_key", "left").withColumn("_gone", F.coalesce("_gone", F.array().cast("array<int>")))
