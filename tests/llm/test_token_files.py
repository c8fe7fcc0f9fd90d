import glob
import zlib
from array import array

import public_tokenizers
import pyarrow.orc as orc
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from signpost.llm.queries import QUERIES
from signpost.llm.token_files import Encoder, read_tokens, tokenized, write_tokens

FILE = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    encoder, start, out = Tokenizer.from_file(FILE), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    return out


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in tokenized(docs, FILE).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == sorted(brute(rows))


def test_round_trip_and_file_features(spark, tmp_path):
    rows = [(5, "Hello world"), (2, None), (2, ""), (None, "née 😀"), (9, "word " * 300_000), (3, "same"), (3, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("x"), "start": F.lit(1), "part": F.lit(2)})
    path = str(tmp_path / "tokens")
    write_tokens(docs, path, FILE)
    got = read_tokens(spark, path).orderBy("start").collect()
    decoder = Tokenizer.from_file(FILE)
    want = brute(rows)
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [w[:3] for w in want]
    assert [decoder.decode(r.ids[:-1], skip_special_tokens=False) for r in got] == ["née 😀", "", "", "same", "same", "Hello world", "word " * 300_000]
    assert all(r.ids[-1] == 0 for r in got)
    files = [orc.ORCFile(f) for f in glob.glob(f"{path}/*.orc")]
    assert sum(f.nrows for f in files) == len(rows) and all(f.compression == "ZSTD" for f in files)
    plan = read_tokens(spark, path).filter("doc_id = 5").select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5)" in plan


def test_special_strings_are_text_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id long, text string")
    assert tokenized(docs, FILE).first().n_tokens > 4
    assert tokenized(docs.limit(0), FILE).collect() == []


ENCODER = Encoder(FILE)
ODD = ["", " ", "\n", "a\n\nb", "a \n b", "\n\na", "it's they'll 'tis don't,'s", "é\u3000 x", "a\xa0 b", "x\x1c y", "naïve œuvre ßtraße", "word1 2word 3.5", "a  b   c    ", "\t\tx\r\ny",
       "e\u0301a ", "日本語 text 日本", "😀😀 a😀b", "A-B/C|D <b>", " leading", "trailing ", "²x½", "aªº b", "\x85 a", "x\x0b\x0c y", "ﬁ ﬁn"]


@pytest.mark.parametrize("text", ODD)
def test_chunks_give_the_ids_of_the_whole_text(text):
    assert np.frombuffer(ENCODER.encode(text), dtype="<i4").tolist() == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="aB é'sl1,.\n\t \xa0\u3000-œ\u0301日😀\x1c", max_size=40))
def test_chunks_give_the_ids_of_any_text(text):
    assert np.frombuffer(ENCODER.encode(text), dtype="<i4").tolist() == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(Encoder, "LIMIT", 3)
    small, text = Encoder(FILE), "one two three four five one two three " * 20
    assert small.encode(text) == ENCODER.encode(text) and len(small) <= 3


def test_what_is_remembered_stays_below_its_bytes():
    small = Encoder(FILE)
    small.BYTES = 20_000
    for i in range(500):
        text = f"word{i} and word{i // 2} again"
        assert small.encode(text) == ENCODER.encode(text) and small.held <= 10_000
    assert small.older and len(small) + len(small.older) <= 2 * 10_000 // 150
    small.trim()
    assert len(small) + len(small.older) <= 10_000 * 5 // 4 // 150 and small.encode("one") == ENCODER.encode("one")


@pytest.mark.parametrize("text", ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|>  y<|endoftext", "<|endoftext|><|endoftext|>\n\u3000é"])
def test_the_special_option_encodes_as_the_library_does(text):
    plain = Tokenizer.from_file(FILE).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(Encoder(FILE, special=True).encode(text), dtype="<i4").tolist() == plain
    assert np.frombuffer(ENCODER.encode(text), dtype="<i4").tolist() != plain


def test_query_encodes_as_the_library_does(spark, tmp_path):
    rows = [(1, "a<|endoftext|>b"), (2, "after it")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op4_token_files"](spark, str(tmp_path)).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(tuple(r) for r in got) == brute(rows)
