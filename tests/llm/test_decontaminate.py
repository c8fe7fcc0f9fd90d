import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from signpost.llm.decontaminate import clean, contamination
from tests.llm.common import same_as_sql

LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = split(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, names = split(text), set(), set()
        for window, owners in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    names |= owners
        listed = sorted(str(n) for n in names if n is not None)
        out.append((str(doc), len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def got(frame):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect())


@pytest.mark.parametrize("block_rows", [100_000, 2])
def test_random_texts_equal_brute_force(spark, block_rows):
    random.seed(4)
    words = ["a", "b", "É", "9", "the"]

    def text(n):
        return "".join(random.choice(words).upper() + random.choice([" ", ", ", "\n", "--"]) for _ in range(n))

    items = [(i, text(random.choice([1, 2, 5, 10, 12]))) for i in range(6)] + [(7, None), (8, " ."), (None, "b the É"), (9, text(14)), (9, text(3))]
    docs = [(i, text(random.randint(0, 60))) for i in range(30)] + [(50, items[4][1] + " " + items[9][1]), (51, None), (52, ""), (None, "b the É b"), (53, "é"), (53, "É"), (50, "a")]
    docs += [(54, "the a " * 3000), (55, items[0][1]), (55, items[0][1])]
    frame = contamination(spark.createDataFrame(docs, "doc_id long, text string").withColumns({"key": F.lit(1), "window": F.lit("w"), "pos": F.lit(0)}),
                          spark.createDataFrame(items, "item_id long, text string"), block_rows=block_rows)
    assert got(frame) == brute(docs, items)


def test_query_equals_sql(spark):
    same_as_sql(spark, "/root/testdata/sf0.001", "op9_decontamination")
    same_as_sql(spark, "/root/testdata/sf0.01", "op9_decontamination")


def test_clean_drops_what_is_contaminated(spark):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted(r.doc_id for r in contamination(docs, items).filter("NOT contaminated").collect())
    kept = clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert contamination(docs.limit(0), items).collect() == []
    assert got(contamination(docs, items.limit(0))) == [("1", 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = contamination(docs, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_words_are_counted_by_one_split(spark):
    from signpost.llm.decontaminate import word_count

    texts = [None, "", " ", "--", "One", " one TWO ", "a-b_c9", "\u00e9t\u00e9 \u4f60\u597d,x", "\n\ta\x00b\x7fc", "A" * 50, "@`[{ z"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.n for r in docs.select("doc_id", word_count(F.col("text")).alias("n")).collect()}
    assert got == {i: len(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")) for i, t in enumerate(texts)}
    items = spark.createDataFrame([(1, "no such words")], "item_id long, text string")
    # counting all matches of a pattern builds each of them, at twice the time of a split
    assert "regexp_count" not in contamination(docs, items)._jdf.queryExecution().toString()
