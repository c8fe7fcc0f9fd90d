import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signpost.llm.conversations import AFTER_A, START, Tables, damaged, digest, repair
from signpost.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def brute_edits(symbols):
    """(cost, letters) by dynamic programming over whole strings; symbols are (initial, must go, truncated)."""
    keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    fill = [2, 2, 3, 2]
    best = [(0, ""), (10, "II"), (5, "I"), (0, "")]
    for initial, must_go, late in reversed(symbols):
        extra = 5 if late else 0
        now = []
        for state in range(4):
            ways = [(2 + best[state][0], "D" + best[state][1])]
            if not must_go:
                if (state, initial) in keep:
                    cost, rest = best[keep[state, initial]]
                    ways.append((extra + cost, "K" + rest))
                cost, rest = best[fill[state]]
                ways.append((1 + extra + cost, "R" + rest))
            now.append(min(ways))
        for _ in range(4):
            now = [min(x, (5 + now[fill[s]][0], "I" + now[fill[s]][1])) for s, x in enumerate(now)]
        best = now
    return best[0]


def brute_digest(rows):
    """The contract, row by row, over (conv_id, turn, role, text)."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        found[conv] += []
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        found[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, chat in found.items():
        chat.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in chat:
            rest = text.rstrip(SPACE)
            fault = "blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
        cost, audit = brute_edits([(r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(chat, faults, strict=True)])
        lines, rest, last = [], iter(chat), ""
        for letter in audit:
            row = next(rest) if letter != "I" else (None, None, "")
            if letter != "D":
                role = row[1] if letter == "K" else "assistant" if last == "u" else "user"
                lines.append(f"{role}:{row[2]}")
                last = role[:1]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines))
        turns = [t for t, _, _ in chat if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(chat, chat[1:], strict=False)]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    rows = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("block", [1, 3, 4])
@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 8), max_size=14))
def test_tables_equal_whole_string_search(block, symbols):
    tables = TABLES[block]
    edits, states = tables.trace(np.array(symbols, dtype=np.uint8))
    ending = {START: "", AFTER_A: "", 1: "II", 2: "I"}[states[-1]]
    want = brute_edits([("sua?"[s % 4], s == 8, 4 <= s < 8) for s in symbols])
    assert "".join(edits) + ending == want[1]
    # the parts of a split sequence, put together, say the same as the whole
    cut = len(symbols) // 2
    first, second = np.array(symbols[:cut], dtype=np.uint8), np.array(symbols[cut:], dtype=np.uint8)
    vector, _ = tables.whole(second)
    middle = int(vector[0])
    _, moved = tables.whole(first)
    left, there = tables.trace(first, middle)
    right, _ = tables.trace(second, 0, there[-1])
    assert left + right == edits and moved[middle][START] == there[-1]


TABLES = {b: Tables(b) for b in (1, 3, 4)}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    want = brute_digest([tuple(r) for r in rows])
    assert got(QUERIES["op13_conversation_repair"](spark, folder)) == want and len(want) >= 20


def odd_rows():
    texts = ["Yes.", "Yes.", None, "", " \n\t", "No", "What? ", " ", "é!", "a" * 50_000 + ".", "three...  \n"]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    rows = [(conv, turn, roles[(conv * 7 + turn) % len(roles)], texts[(conv * 5 + turn * 3) % len(texts)]) for conv in range(60) for turn in range(conv % 13)]
    rows += [(None, None, None, None), (None, 3, "user", "Hi."), (70, None, "user", "Hi."), (70, None, "assistant", "Ho."), (70, None, "assistant", "Ho.")]
    rows += [(71, -(2**63), "user", "Hi."), (71, 2**63 - 1, "assistant", "Ho."), (72, 5, "user", "Same."), (72, 5, "user", "Same."), (72, 5, "assistant", "Other."), (72, 9, "user", "Same.")]
    return rows


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA + ", part string, seq int")
    have, want = got(digest(damaged(df))), brute_digest(rows)
    overflown = have.pop(71)
    assert overflown[1:] == want.pop(71)[1:] and have == want


def test_a_conversation_over_many_partitions(spark):
    roles = ["user", "assistant", "user", "system", "tool"]
    rows = [(5, t, roles[t * t % 5 if t % 3 else t % 2], f"t{t % 700}" + ("." if t % 7 else "")) for t in range(6000)]
    rows += [(c, t, ["user", "assistant"][t % 2], f"c{t}.") for c in (1, 2, 9) for t in range(8)] + [(5, None, "user", "again.")] * 1000
    df = spark.createDataFrame(rows, SCHEMA)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edits = repair(damaged(df))
        parts = {r.part for r in edits.filter("conv_id = 5").select("part").distinct().collect()}
        assert len(parts) > 3
        assert got(digest(damaged(df))) == brute_digest(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "A?"), (1, 1, "tool", "B."), (1, 2, "user", "C."), (1, 2, "user", "C."), (2, 0, "assistant", "D.")]
    found = repair(spark.createDataFrame(rows, SCHEMA)).orderBy("part", "seq").collect()
    one = [(r.edit, r.role, r.text, r.fault, r.copies) for r in found if r.conv_id == 1]
    # giving B. or C. the other role costs the same; deleting first is the lesser letter
    assert one == [("K", "user", "A?", "", 1), ("D", "tool", "B.", "", 1), ("R", "assistant", "C.", "", 1), ("D", "user", "C.", "duplicate", 1)]
    assert [(r.edit, r.text) for r in found if r.conv_id == 2] == [("D", "D.")]


def test_empty_tables_and_other_key_types(spark):
    assert digest(damaged(spark.createDataFrame([], SCHEMA))).collect() == []
    assert repair(spark.createDataFrame([], SCHEMA)).collect() == []
    named = spark.createDataFrame([("a", 1, "user", "Hi."), ("a", 2, "assistant", "Ho."), (None, 1, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    assert {r.conv_id: r.audit for r in digest(named).collect()} == {"a": "KK", None: "D"}
    marks = spark.createDataFrame([("x", None, "", "", 0)], "conv_id string, turn int, role string, text string, copies int")
    row = digest(marks).collect()[0]
    assert (row.cost, row.audit, row.gaps, row.repaired_sha256) == (0, "", 0, hashlib.sha256().hexdigest())


def test_partitionings_agree(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert got(digest(damaged(df.repartition(7, F.rand(1))))) == got(digest(damaged(df)))
