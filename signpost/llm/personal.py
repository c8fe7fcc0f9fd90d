"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

The four base kinds (email, ip, card, phone) are kept whenever their own rule holds. Further kinds are
added where their score reaches THRESHOLD: a kind's first score, plus CONTEXT if one of its words stands
nearby, minus DOUBT if a word stands there that speaks against it, and only if its checksum holds. They
may overlap base spans, as an account number's digits may pass for a card's; only a local phone number
that touches a whole one is that number.
Scanning is linear in the text, also for long runs of digits or of address characters.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost.session import ship_package

THRESHOLD = 0.6
CONTEXT = 0.3
DOUBT = 0.3
REACH = 40  # code points looked at on either side
DOUBTS = frozenset({"version", "isbn", "issn", "order", "invoice", "ticket", "license", "sku"})

_DIGIT = re.compile("[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive runs: a run of digits that fails is passed over as a whole
_IP = re.compile(r"([0-9]++)(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Check digits of an international account number, spaces allowed."""
    compact = account.replace(" ", "")
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def issued(number: str) -> bool:
    """A national insurance number whose parts can have been issued."""
    area, group, serial = number.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


# fixed values: characters of an account number by country; others are tried from long to short
_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
IBAN_SIZE = {code: size for size, codes in _SIZES.items() for code in codes.split()}
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_RUN = re.compile(r"[A-Z0-9](?: ?[A-Z0-9]){14,33}")
_IBAN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers whose check digits hold: of their country's size, whatever capitals or digits follow after a space."""
    last = 0
    for m in _IBAN_START.finditer(text):
        start = m.start()
        run = _IBAN_RUN.match(text, start) if start >= last else None
        if not run:
            continue
        ends = [i + 1 for i in range(start, run.end()) if text[i] != " "]
        size = IBAN_SIZE.get(text[start : start + 2])
        for n in [size] if size else range(len(ends), 14, -1):
            if n <= len(ends) and not _goes_on(text, ends[n - 1]) and mod97(text[start : ends[n - 1]]):
                last = ends[n - 1]
                yield start, last
                break


def _goes_on(text: str, end: int) -> bool:
    return text[end : end + 1].isascii() and text[end : end + 1].isalnum()


def _matches(pattern: str, valid: Callable[[str], bool] = lambda _: True) -> Callable[[str], Iterator[tuple[int, int]]]:
    compiled = re.compile(pattern)
    return lambda text: (m.span() for m in compiled.finditer(text) if valid(m[0]))


@dataclass(frozen=True)
class Kind:
    name: str
    spans: Callable[[str], Iterator[tuple[int, int]]]
    score: float
    near: frozenset[str]
    part_of: str | None = None  # the base kind whose spans it must not touch


ADDED = (
    Kind("iban", _ibans, 0.7, frozenset({"iban", "account", "konto", "compte", "cuenta", "bank", "banque", "banco"})),
    Kind("ssn", _matches(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", issued), 0.4, frozenset({"ssn", "social", "security"})),
    Kind("local_phone", _matches(r"(?<![0-9+)(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"), 0.4,
         frozenset({"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "handy"}), "phone"),
)
BASE = ("email", "ip", "card", "phone")
ORDER = {kind: i for i, kind in enumerate((*BASE, *(k.name for k in ADDED)))}


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping: around each @ the run of address characters before it and a domain after it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        last = found.end() if found else at + 1
        at = text.find("@", last)


def _byte(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if m[2] is not None and all(map(_byte, m.groups())):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def _score(kind: Kind, text: str, start: int, end: int) -> float:
    around = {w.lower() for w in _WORD.findall(text, max(0, start - REACH), start)} | {w.lower() for w in _WORD.findall(text, end, end + REACH)}
    return kind.score + CONTEXT * bool(around & kind.near) - DOUBT * bool(around & DOUBTS)


def _merged(spans: Iterable[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that overlapping spans cover."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def spans_of(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, end exclusive, by start and kind; added spans may overlap base ones."""
    if not text:
        return []
    base = base_spans(text)
    spans = [(*s, 1.0) for s in base]
    if _DIGIT.search(text):
        for kind in ADDED:
            starts, ends = _merged(s[1:] for s in base if s[0] == kind.part_of)
            for start, end in kind.spans(text):
                # of the base stretches that begin before the end, the last one reaches furthest
                before = bisect_left(starts, end)
                free = not before or ends[before - 1] <= start
                if free and (score := _score(kind, text, start, end)) >= THRESHOLD:
                    spans.append((kind.name, start, end, round(score, 3)))
    return sorted(spans, key=lambda s: (s[1], ORDER[s[0]], s[2]))


def personal_data(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) as (doc_id, spans): spans is an array of (kind, start, end, score), empty for null texts.

    Whole texts; other columns are ignored; one row out for each row in.
    """
    ship_package(docs.sparkSession)

    @F.pandas_udf("array<struct<kind:string,start:int,end:int,score:double>>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans_of(t)] for t in texts], dtype=object)

    return docs.select("doc_id", F.coalesce(found("text"), F.array()).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = map(count, BASE)
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
