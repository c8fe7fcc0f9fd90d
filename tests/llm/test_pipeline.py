from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from signpost.llm.simhash import one_of_each
from tests.llm.test_simhash import brute_components, brute_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_one_of_each_group_stays(spark, sent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in rows])
    kept = one_of_each(docs, sent=sent)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, c in want.items() if d == c)


def test_one_of_each_with_odd_rows(spark):
    rows = [(2, "a b c d e f"), (2, "a b c d e f"), (2, "other words entirely here now"), (1, "a b c d e F"), (None, "a b c d e f"), (None, "z z y"), (None, "Z z y"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit(0), "_hash": F.lit("x"), "n": F.lit(1), "_doc": F.lit(2)})
    got = [(r.doc_id, r.text) for r in one_of_each(docs).collect()]
    assert Counter(g[0] for g in got) == Counter([1, 2, 3, None])
    assert (1, "a b c d e F") in got and (2, "other words entirely here now") in got and (3, None) in got
    assert one_of_each(docs.limit(0)).collect() == []


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, words, "en", "s", 9), (2, words, "en", "s", 9), (3, words + " more", None, None, 1), (4, "x " * 40_000, "en", "s", 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for given in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, given, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= 3 * len(rows)
        assert corpus_pipeline.STAGES[-1][1](spark, given, SF).count() == given.count()


def test_stages_take_columns_of_any_name(spark):
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(1, words, "en", "s", 9, 1, 2, 3), (2, words + " more of it", "en", "s", 9, 4, 5, 6)]
    docs = spark.createDataFrame(rows, SCHEMA + ", `a.b` int, `c d` int, `e``f` int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert (r["a.b"], r["c d"], r["e`f"]) == ((1, 2, 3) if r.doc_id == 1 else (4, 5, 6))


def test_pipeline_runs_every_stage(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and rows[0].asDict().keys() == {"doc_id", "start", "n_tokens", "ids_crc32"}
    ends = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == ends
        ends += r.n_tokens


def test_texts_go_to_python_in_small_batches(spark):
    name, rows = corpus_pipeline.BATCH
    before = spark.conf.get(name)
    try:
        for given, kept in (("10000", str(rows)), ("0", str(rows)), ("7", "7")):
            spark.conf.set(name, given)
            corpus_pipeline.quality_rules(spark, spark.createDataFrame([], "doc_id long, text string, lang string, source string"), "")
            assert spark.conf.get(name) == kept
    finally:
        spark.conf.set(name, before)
