"""Language and quality models: held-out accuracy and odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from signpost.llm.language import classify, content, dictionaries, identify, predict
from signpost.llm.quality_model import Tokens, features, fit, learn, rate, score

SF = "/root/testdata/sf0.1"


def remainder(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = identify(docs).collect()
    assert len(rows) == len(labels)
    assert all(r.held_out == (remainder(r.doc_id) == 2) and 0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es", "und"} for r in rows)
    test = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == labels[r.doc_id] for r in test) / len(test) > 0.97
    sure = [r for r in test if r.confident]
    assert len(sure) > 0.9 * len(test) and sum(r.lang_pred == labels[r.doc_id] for r in sure) / len(sure) > 0.975


def test_language_learns_nothing_from_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    changed = docs.withColumn("text", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("zzz " * 9)).otherwise(F.col("text")))
    assert dictionaries(docs) == dictionaries(changed.repartition(5))


def test_language_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "123 !! ²"), (None, "the and of"), (4, "The " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit(1), "lang_pred": F.lit("x")})
    learned = [("en", b"of and the thing with"), ("fr", b"des les une est que")]
    got = {r.doc_id: (r.lang_pred, r.held_out) for r in predict(docs, learned).collect()}
    assert got == {1: ("und", remainder(1) == 2), 2: ("und", remainder(2) == 2), 3: ("und", remainder(3) == 2), None: ("en", False), 4: ("en", remainder(4) == 2)}
    assert predict(docs.limit(0), learned).collect() == [] and classify("words", []) == ("und", 0.0, False)
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in identify(unlabelled).collect()} == {"und"}
    assert content("Ab ab, CD 1 ab") == b"ab cd"


def test_quality_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = rate(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id in quality]
    assert sum(r.predicted == quality[r.doc_id] for r in test) / len(test) > 0.98
    good = [r for r in test if quality[r.doc_id] == 1]
    assert sum(r.predicted for r in good) / len(good) > 0.98


def test_quality_learns_nothing_from_held_out_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = learn(docs, labels), learn(docs.repartition(5), flipped.repartition(3))
    assert np.array_equal(one.weights, two.weights) and (one.bias, one.slope, one.shift) == (two.bias, two.slope, two.shift)


def test_quality_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "plain words"), (4, "$$$ " * 100_000), (4, "$$$ " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"quality": F.lit(9), "score": F.lit("x"), "row": F.lit(0)})
    labels = spark.createDataFrame([(1, None), (None, 1), (4, 0), (4, 0), (77, 1)], "doc_id long, quality int").withColumn("text", F.lit("clash"))
    got = rate(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert score(docs.limit(0), learn(docs.limit(0), labels.limit(0))).collect() == []


def test_fit_separates_and_calibrates():
    tokens = Tokens()
    clean = [features(f"plain words number w{i} here", tokens) for i in range(60)]
    junk = [features(f"Junk!!! ### w{i} $$$", tokens) for i in range(60)]
    rows = [r for pair in zip(clean, junk, strict=True) for r in pair]
    model = fit([r.astype(np.int64) for r in rows], np.array([True, False] * 60))
    assert all(model.score(r) > 0.7 for r in clean) and all(model.score(r) < 0.3 for r in junk)
    assert 0 <= model.score(np.empty(0, dtype=np.int64)) <= 1
