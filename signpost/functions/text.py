"""Text columns: whitespace, decoding, media types and body-shape tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from signpost import values as V

# every Unicode space plus the four ASCII separators
SPACE = r"[\s\x1c-\x1f]"
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def strip_left(c: Column) -> Column:
    return F.ltrim(c, F.lit(SPACES))


def collapse(c: Column) -> Column:
    """Every whitespace run becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(c, rf"(?U){SPACE}+", " "))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def lines(c: Column) -> Column:
    return F.split(c, LINE_BREAK)


def utf8(body: Column) -> Column:
    """Body bytes as text; malformed sequences become the replacement character."""
    return F.make_valid_utf8(body.cast("string"))


def contains_any(c: Column, markers: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(m) for m in markers])


def media_type(content_type: Column) -> Column:
    return blank_to_null(F.lower(strip(F.split_part(content_type, F.lit(";"), F.lit(1)))))


def _falsy_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def is_json_type(content_type: Column) -> Column:
    m = media_type(content_type)
    return _falsy_null((m == "application/json") | m.endswith("+json"))


def is_xml_type(content_type: Column) -> Column:
    m = media_type(content_type)
    return _falsy_null(m.isin("application/xml", "text/xml") | m.endswith("+xml"))


def is_text_type(content_type: Column) -> Column:
    m = media_type(content_type)
    return _falsy_null(m.isin(*V.TEXT_MEDIA_TYPES) | m.startswith("text/"))


def is_html_type(content_type: Column) -> Column:
    return _falsy_null(media_type(content_type) == "text/html")


def is_login_handoff(text: Column) -> Column:
    low = F.lower(text)
    hits = reduce(lambda a, b: a + b, [low.contains(m).cast("int") for m in V.LOGIN_BODY_MARKERS])
    return hits >= 2


def is_html_fragment(text: Column) -> Column:
    return text.contains("<") & text.contains(">") & contains_any(F.lower(text), V.HTML_MARKERS)


def is_markup_fragment(text: Column) -> Column:
    body = strip_left(text)
    starts = "|".join([r"<\?xml"] + [s for s in V.MARKUP_STARTS])
    return body.startswith("<") & (
        is_html_fragment(body)
        | body.startswith("<?xml")
        | F.lower(body).rlike(f"^(?:{starts})")
        | body.rlike(r"^<[a-zA-Z][\w:-]*(?:\s|>|/)")
    )


def is_error_page(text: Column) -> Column:
    low = F.lower(text)
    return (
        contains_any(low, V.ERROR_PAGE_MARKERS)
        | (low.contains("page not found") & is_html_fragment(text))
        | (low.contains("not found") & low.contains("redirecturl="))
    )


def preview(text: Column, max_length: int = 180) -> Column:
    """One-line preview of a whole text, cut only when it is longer than `max_length`."""
    flat = collapse(text)
    cut = F.concat(F.rtrim(F.substring(flat, 1, max_length - 3)), F.lit("..."))
    return F.when(flat == "", None).when(F.char_length(flat) <= max_length, flat).otherwise(cut)


def status_word(c: Column) -> Column:
    return blank_to_null(F.lower(strip(c)))


def is_live(c: Column) -> Column:
    return _falsy_null(status_word(c).isin(*V.LIVE_STATUSES))


def is_active_offer(c: Column) -> Column:
    """A missing status counts as active."""
    return status_word(c).isNull() | is_live(c)


def is_prelaunch(c: Column) -> Column:
    return _falsy_null(status_word(c).isin(*V.PRELAUNCH_STATUSES))


def is_human_checkout(c: Column) -> Column:
    return _falsy_null(status_word(c) == "human_browser_checkout")


def is_placeholder(c: Column) -> Column:
    return _falsy_null(contains_any(F.lower(c), V.PLACEHOLDER_MARKERS))
