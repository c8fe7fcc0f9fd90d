"""Token files: ORC with integer run-length encoding, row indexes and Bloom filters on document ids.

Texts are range-partitioned and sorted by doc_id, then encoded where they lie, so the encoder runs once
and each task writes one file in order. A word is encoded once per task as long as it is remembered. A row holds the ids of one document and `local_start`, the ids
of the file before it; run-length encoding makes both, and the file number `part`, cheap. A reader takes
stripes in parallel, prunes stripes and row groups by the doc_id statistics and Bloom filters, and gets
global positions from one sum per file. Ids stay in bounded batches on the way in and out.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signpost.session import scratch_path, ship_package

END_ID = 0
BATCH_BYTES = 1 << 20
OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(32 << 20),
}
_ROW = "doc_id long, part int, local_start long, n_tokens int, ids array<int>"


_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
# Places where byte-level pre-tokenizers always cut: before white space that follows something else, and
# between a word of plain letters and ASCII that is no letter. A single line break before a word stands alone.
_CHUNK = re.compile(rf"\n(?=[{_LETTER}])|[ \n\r\t]*(?:[{_LETTER}]+(?![^\x00-\x7f]|[A-Za-z])|[^ \n\r\t]+)|[ \n\r\t]+")
_WORD = re.compile(rf" ?[{_LETTER}]+")
# white space that the rules above do not know: such texts are encoded as a whole
_OTHER_SPACES = [c for c in map(chr, range(0x110000)) if c.isspace() and c not in " \n\r\t"]


def _alphabet() -> dict[int, str]:
    """The visible character that byte-level vocabularies write for each byte: itself, or the next one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder(dict):
    """chunk -> its ids as little-endian 32-bit integers, remembered up to BYTES.

    Texts repeat their words: a chunk is given to the tokenizer once, not once per place. Chunks are cut
    only where the tokenizer itself cuts, so the ids are those of the whole text. What is remembered is held in
    two halves; when the newer is full, it takes the place of the older, from which chunks in use come back.
    `trim` drops the older at the end of a task, so idle workers hold little. With `special`, a text that
    spells a special token gets that token's id there, as the library does by default; without, it is ordinary text.
    """

    BYTES = 96 << 20
    LIMIT = 700_000  # chunks of a half

    def __init__(self, tokenizer_file: str, special: bool = False) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder().values()
        # texts with one of these are encoded as a whole
        self.whole = [*_OTHER_SPACES, *(t.content for t in added if special or not t.special)]
        self.model = self.tokenizer.model
        self.alphabet = _alphabet()
        self.space = self.alphabet[32]
        self.older: dict[str, bytes] = {}
        self.held = 0

    def trim(self) -> None:
        """Keep one half only: what an idle worker holds until its next task."""
        if self.held >= self.BYTES // 8:
            self.older = {}

    def __missing__(self, chunk: str) -> bytes:
        value = self.older.get(chunk)
        if value is None:
            if _WORD.fullmatch(chunk):  # one piece
                if chunk.isascii():  # a letter is its own visible character
                    piece = self.space + chunk[1:] if chunk[0] == " " else chunk
                else:
                    piece = chunk.encode().decode("latin-1").translate(self.alphabet)
                ids = [t.id for t in self.model.tokenize(piece)]
            else:
                ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            value = array("i", ids).tobytes()
        size = len(chunk)
        if size <= 64:
            self.held += 150 + size + len(value)  # about what both objects and their place in the table take
            if self.held > self.BYTES // 2 or len(self) >= self.LIMIT:
                self.older, self.held = dict(self), 0
                self.clear()
            self[chunk] = value
        return value

    def encode(self, text: str) -> bytes:
        if any(map(text.__contains__, self.whole)):
            return array("i", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, _CHUNK.findall(text)))


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder_of(tokenizer_file: str, special: bool = False) -> Encoder:
    """One encoder per worker process, file and option: the vocabulary is read once."""
    key = (tokenizer_file, special)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(tokenizer_file, special)
    return _ENCODERS[key]


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """(doc_ids, texts) of a batch in pieces of about BATCH_BYTES of text."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
        value = text.as_py() or ""
        ids.append(doc_id.as_py())
        texts.append(value)
        size += len(value)
        if size >= BATCH_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID, special: bool = False) -> None:
    """Write the ids of every text of `docs` (doc_id, text), `end_id` after each, as ORC files under `path`.

    Files follow each other in ascending doc_id order (null ids first, repeated ids by text) and rows
    inside them too. Null texts are empty ones; what spells a special token is
    ordinary text, or with `special` that token.
    `tokenizer_file` must have the same path on every machine.
    """
    ship_package(docs.sparkSession)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end = encoder_of(tokenizer_file, special), array("i", [end_id]).tobytes()
        part, before = TaskContext.get().partitionId(), 0
        try:
            for batch in batches:
                for doc_ids, texts in _slices(batch):
                    rows = [encoder.encode(t) + end for t in texts]
                    sizes = np.array([len(r) // 4 for r in rows], dtype=np.int64)
                    ends = np.cumsum(sizes)
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(np.frombuffer(b"".join(rows), dtype="<i4")))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids, pa.int64()), pa.array(np.full(len(rows), part, dtype=np.int32)), pa.array(before + ends - sizes),
                         pa.array(sizes.astype(np.int32)), lists],
                        names=["doc_id", "part", "local_start", "n_tokens", "ids"])
                    before += int(ends[-1])
        finally:
            encoder.trim()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encoded, _ROW).write.options(**OPTIONS).orc(path)


def _with_start(rows: DataFrame, path: str) -> DataFrame:
    """`rows` of the files under `path` with `start` instead of (part, local_start)."""
    files = rows.sparkSession.read.schema(_ROW).orc(path).groupBy("part").agg(F.sum("n_tokens").alias("_ids"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    offsets = files.select("part", F.coalesce(F.sum("_ids").over(ahead), F.lit(0)).alias("_offset"))
    start = (F.col("_offset") + F.col("local_start")).alias("start")
    return rows.join(offsets, "part").select("doc_id", start, *[c for c in rows.columns if c not in ("doc_id", "part", "local_start")])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of the files; start counts all ids before it."""
    return _with_start(spark.read.schema(_ROW).orc(path), path)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files: crc32 of the ids as little-endian 32-bit integers."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            counts = pa.array(np.diff(offsets).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], counts, pa.array(sums, pa.int64())], names=names)

    names = ["doc_id", "part", "local_start", "n_tokens", "ids_crc32"]
    rows = spark.read.schema(_ROW).orc(path).select("doc_id", "part", "local_start", "ids")
    return _with_start(rows.mapInArrow(summed, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long"), path)


def tokenized(docs: DataFrame, tokenizer_file: str, path: str | None = None, special: bool = False) -> DataFrame:
    """Write `docs` as token files under `path` (a new folder of the shared one by default) and sum them up from there."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_file, special=special)
    return checksums(spark, path)
