import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from signpost.llm.quality_rules import VECTOR, judge, keep_good, text_counts

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("text", [
    None, "", " \n\t", "a b c d e a b c d e", "x " * 50, "a b c d e f a b c d e g h i j k f a b c d e", "one\ntwo\n \none\none \n", "É#ü 𝄞|𝄞 <b>&amp;", "a\x0bb\x0cc\rd\x1ce\x85f　g"])
def test_counts_equal_brute_force(text):
    assert text_counts(None if text is None else text.encode())[:5] == brute(text)


def test_query_counts_and_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = judge(docs).collect()
    assert len(rows) == len(texts)
    good, bad = [], []
    for r in rows:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.base_failed and r.kept)
        if r.doc_id in quality and not r.base_failed:
            (good if quality[r.doc_id] else bad).append(r.kept)
    assert sum(good) / len(good) > 0.995 and sum(bad) / len(bad) < 0.1


def test_verdicts_do_not_depend_on_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one = sorted(judge(docs).select("doc_id", "kept", "distance").collect(), key=str)
    assert sorted(judge(docs.repartition(11, F.rand(2))).select("doc_id", "kept", "distance").collect(), key=str) == one


def test_planted_outliers_go_and_contamination_does_not_hide_them(spark):
    # a fifth of one source is symbol soup; enough to move a plain mean and covariance
    def text(i, junk):
        draw = random.Random(i)
        words = ["".join(draw.choice("abcdefghij") for _ in range(4)) for _ in range(60 + i % 50)]
        return " ".join(w + "$#" for w in words) if junk else " ".join(words)

    rows = [(i, text(i, i % 5 == 0), "en", "s") for i in range(600)]
    got = {r.doc_id: r.kept for r in judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] != (i % 5 == 0) for i in range(600))


def test_a_text_ten_deviations_off_its_group_goes(spark):
    def text(i, sizes):
        draw = random.Random(i)
        return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.choice(sizes))) for _ in range(80 + i % 60))

    rows = [(i, text(i, (3, 4, 5, 6, 7) if i else (7,)), "en", "s") for i in range(400)]
    kept = {r.doc_id: r.kept for r in judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not kept[0] and sum(kept.values()) >= 397


def test_odd_rows(spark):
    words = " ".join(f"word{chr(97 + i)}" for i in range(20))
    rows = [(1, None, "en", "s"), (2, "", None, None), (None, words, None, "s"), (3, words, "en", None), (3, words, "en", None), (4, "long text " * 50_000, "en", "s")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(1) for n in [*VECTOR, "grp", "kept", "_doc", "n_words", "own", "e"]})
    got = sorted((str(r.doc_id), r.base_failed, r.kept) for r in judge(docs).collect())
    assert got == sorted([("1", True, False), ("2", True, False), ("None", False, True), ("3", False, True), ("3", False, True), ("4", True, False)])
    kept = keep_good(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "3", "None"]
    assert judge(docs.limit(0)).collect() == [] and keep_good(docs.limit(0)).collect() == []
