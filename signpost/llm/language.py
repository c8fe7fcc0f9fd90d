"""Language by compression: one zstandard dictionary of raw words per language, the smallest code wins.

A dictionary is learned in Spark from a bounded sample of labelled documents: the words much more
frequent in documents of that language than of the others, by document frequency, the most frequent
last (where a code reaches them most cheaply). A text is encoded as its distinct words in order of
appearance, lower-cased, so a word repeated a thousand times counts once; every word of the whole text
is read. The language whose dictionary gives the smallest code is named; where the second smallest is
within NARROW of it, the row says that it is not `confident`.
"""

from __future__ import annotations

import re

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signpost.session import cut, ship_package

SAMPLE = 4000  # labelled documents looked at per language, in expectation
WORDS = 8000  # per dictionary
LEVEL = 9
MIN_DOCS = 3
LEAN = 2.0  # times more frequent than in the other languages
NARROW = 0.01
UNKNOWN = "und"
MAX_LANGUAGES = 200  # of WORDS words each: some 15 MB sent to every task
_WORD = re.compile(r"[^\W\d_]+")
_WORD_SPARK = r"(?U)[^\W\d_]+"


def held_out(doc_id: Column) -> Column:
    """Documents kept from learning: crc32 of the id as text, modulo 4, is 2. Null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def dictionaries(docs: DataFrame, sample: int = SAMPLE, words: int = WORDS) -> list[tuple[str, bytes]]:
    """(language, dictionary), the commonest language first, from labelled rows that are not held out."""
    learn = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    sizes = cut(learn.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "lang").limit(MAX_LANGUAGES))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 30)) / (1 << 30)
    drawn = learn.join(F.broadcast(sizes), "lang").filter(draw * F.col("rows") < sample)
    found = drawn.select("lang", F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(_WORD_SPARK), 0))).alias("word"))
    counts = cut(found.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("docs")))
    totals = counts.groupBy("lang").agg(F.sum("docs").alias("total"))
    shares = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("docs") / F.col("total"))
    others = F.sum("share").over(Window.partitionBy("word")) - F.col("share")
    many = F.greatest(F.lit(sizes.count() - 1), F.lit(1))
    own = shares.withColumn("others", others / many).filter((F.col("docs") >= MIN_DOCS) & (F.col("share") > LEAN * F.col("others")))
    # one row per language and word of a bounded sample
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("docs"), "word"))
    best = own.withColumn("turn", turn).filter(F.col("turn") <= words)
    listed = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("turn", "word")), asc=False).alias("words"))
    rows = sizes.join(listed, "lang", "left").orderBy(F.desc("rows"), "lang").collect()  # at most MAX_LANGUAGES rows
    return [(r.lang, " ".join(w.word for w in r.words or ()).encode()) for r in rows]


def _coder(words: bytes) -> zstandard.ZstdCompressor:
    options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if len(words) < 8:  # no raw content
        return zstandard.ZstdCompressor(**options)
    raw = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=raw, **options)


def content(text: str | None) -> bytes:
    """What is encoded of a text: its distinct words in order; empty if no character is a letter."""
    found = dict.fromkeys(_WORD.findall((text or "").lower()))
    return " ".join(found).encode() if any(any(map(str.isalpha, w)) for w in found) else b""


def classify(text: str | None, coders: list[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float, bool]:
    """(language, score, confident); equal codes go to the language that comes first."""
    words = content(text)
    if not words or not coders:
        return UNKNOWN, 0.0, False
    sizes = sorted((len(coder.compress(words)), i) for i, (_, coder) in enumerate(coders))
    best, at = sizes[0]
    margin = (sizes[1][0] - best) / sizes[1][0] if len(sizes) > 1 else 1.0
    return coders[at][0], margin / (margin + NARROW) if margin else 0.0, margin >= NARROW


def predict(docs: DataFrame, learned: list[tuple[str, bytes]]) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, confident) for every row of `docs` (doc_id, text).

    Null texts and texts without a letter are `und` with score 0. Only the text is looked at.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(learned)

    @F.pandas_udf("lang_pred string, score double, confident boolean")
    def named(texts: pd.Series) -> pd.DataFrame:
        coders = [(lang, _coder(words)) for lang, words in sent.value]
        return pd.DataFrame([classify(t, coders) for t in texts], columns=["lang_pred", "score", "confident"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), named("text").alias("p")).select("doc_id", "held_out", "p.*")


def identify(docs: DataFrame, sample: int = SAMPLE, words: int = WORDS) -> DataFrame:
    """Learn from the labelled rows of `docs` (doc_id, text, lang) that are not held out, and name the language of all."""
    return predict(docs, dictionaries(docs, sample, words))
