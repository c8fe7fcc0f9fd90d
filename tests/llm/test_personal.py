import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signpost.llm.personal import base_spans, digest, luhn, mod97, personal_data, spans_of

# the rules as they are stated, tried the slow way
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


TEXTS = [
    "a@b.com@c.org x@y.z.w@q.r a@@b.c @d.e f@g h.i-j%k+l@m-n.o_p.q", "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3 4.5.6.7",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 1111 1111 0000000000000000", "+1 (555) 555-4324 +12 +123456789 +1234567890123456 + 1 555 +1..........2 +1+2 33 44 55 66",
    "é@é.com ü1.2.3.4ß 😀 a.b@c-d.e", "", "9" * 300 + ".1.1.1",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_equal_the_rules(text):
    assert base_spans(text) == brute(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1290.@+- ()%é", max_size=60))
def test_base_spans_equal_the_rules_on_any_text(text):
    assert base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    assert base_spans("7" * 400_000 + " " + "a" * 400_000 + "@" + "+1" + " (" * 200_000) == []


def test_added_kinds_need_checksum_or_context():
    def kinds(text):
        return [s[0] for s in spans_of(text)]

    assert mod97("GB82 WEST 1234 5698 7654 32") and not mod97("GB83 WEST 1234 5698 7654 32")
    assert kinds("pay to GB82 WEST 1234 5698 7654 32 now") == ["iban"]
    assert kinds("pay to GB83 WEST 1234 5698 7654 32 now") == []
    assert kinds("his social security number 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == [] and kinds("ssn 000-45-6789") == []
    assert kinds("call 555-123-4567") == ["local_phone"] and kinds("order 555-123-4567") == [] and kinds("call +1 555-123-4567") == ["phone"]


@pytest.mark.parametrize(("text", "want"), [
    ("IBAN DE89 3704 0044 0532 0130 00 BIC: COBADEFF", "DE89 3704 0044 0532 0130 00"), ("GB82 WEST 1234 5698 7654 32 USD 500", "GB82 WEST 1234 5698 7654 32"),
    ("DE89370400440532013000 EUR 20", "DE89370400440532013000"), ("DE89 3704 0044 0532 0130 00 12 000", "DE89 3704 0044 0532 0130 00"),
    ("AB12 3456 7890 DE89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 00"), ("ZZ59 ABCD 1234 5678 9012 X", None), ("DE89370400440532013000X", None),
    ("DE89 3704 0044 0532 0130 0", None)])
def test_account_numbers_end_where_their_country_says(text, want):
    assert [text[a:b] for k, a, b, _ in spans_of(text) if k == "iban"] == ([want] if want else [])


def test_account_number_of_a_country_without_a_size():
    number = next(f"ZZ{i:02} ABCD 1234 5678 9012" for i in range(2, 99) if mod97(f"ZZ{i:02} ABCD 1234 5678 9012"))
    assert [number for k, *_ in spans_of(f"to {number} EUR") if k == "iban"] == [number]


def test_added_spans_may_overlap_base_ones():
    numbers = (f"GB{c:02} WEST {a:04} 5698 7654 {b:02}" for c in range(2, 99) for a in range(1200, 1210) for b in range(100))
    number = next(n for n in numbers if mod97(n) and luhn(n[10:].replace(" ", "")))
    assert [(k, number[a:b]) for k, a, b, _ in spans_of(number)] == [("iban", number), ("card", number[10:])]
    assert spans_of("7A" * 100_000 + " DE89" * 50_000) == []


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    order = {k: i for i, k in enumerate(RULES)}
    rows = digest(personal_data(docs)).collect()
    assert len(rows) == len(texts) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 20
    for r in rows:
        spans = sorted(brute(texts[r.doc_id]), key=lambda s: (s[1], order[s[0]]))
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in RULES]
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a@b.co"), (3, "a@b.co"), (3, "a@b.co"), (4, "x " * 100_000 + "1.2.3.4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"spans": F.lit("s"), "n_ip": F.lit(1)})
    got = sorted((str(r.doc_id), r.n_email, r.n_ip, r.spans) for r in digest(personal_data(docs)).collect())
    assert got == sorted([("1", 0, 0, ""), ("2", 0, 0, ""), ("None", 1, 0, "email:0:6"), ("3", 1, 0, "email:0:6"), ("3", 1, 0, "email:0:6"), ("4", 0, 1, "ip:200000:200007")])
    assert digest(personal_data(docs.limit(0))).collect() == []
