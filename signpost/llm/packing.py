"""Best-fit packing by a configuration linear program over the length histogram.

Pieces of equal length are interchangeable, so what has to be packed is a histogram of at most SIZE lengths,
however many documents there are. A configuration is a multiset of lengths that fit one sequence. The
program "fewest sequences whose configurations cover the histogram" is solved by multiplicative weights: the
price of a length falls exponentially with the share of it that is covered, the configurations that are worth
most come from a knapsack by dynamic programming under (slightly shaken) prices, and each is taken as often
as no length gains more than STEP of its count. The prices also give a lower bound. Multiplicities are rounded
down at several scales of the solution; what is left goes into the gaps and new sequences by best fit, longest
first, whole groups of equal sequences at a time; the scale that needs the fewest sequences is kept.

Which piece goes where is settled without moving texts: a piece's rank among those of its length comes from
its task, its rank there and a prefix sum over tasks, and ranks are dealt to the slots of the solution.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signpost.llm.token_files import _slices, encoder_of
from signpost.session import ship_package, stored

SIZE = 1024
END_ID = 2
ROUNDS = 60
SHAKEN = 4  # price vectors priced at once
STEP = 0.1
SCALES = (1, 1.2, 1.5, 2, 3, 4, 6, 8, 16)
_RANK_BITS = 48

_PIECE = "part int, doc_id long, piece int, start long, length int, ids_crc32 long, rank long"


def knapsacks(prices: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(worth, last): for every room up to `size` and each row of prices, the best worth and the length index taken last (-1: none)."""
    many = len(prices)
    worth, last = np.zeros((size + 1, many)), np.full((size + 1, many), -1, dtype=np.int32)
    column, each = np.ascontiguousarray(prices.T), np.arange(many)
    for room, fit in enumerate(np.searchsorted(lengths, np.arange(size + 1), side="right")):
        if not fit:
            continue
        found = worth[room - lengths[:fit]] + column[:fit]
        at = found.argmax(axis=0)
        best = found[at, each]
        better = best > worth[room - 1]
        worth[room], last[room] = np.where(better, best, worth[room - 1]), np.where(better, at, -1)
    return worth, last


def _content(last: np.ndarray, lengths: np.ndarray, room: int) -> list[int]:
    """Length indexes of the best filling of `room`."""
    found = []
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            found.append(int(last[room]))
            room -= int(lengths[last[room]])
    return found


def weighted_cover(counts: np.ndarray, rounds: int = ROUNDS, seed: int = 1) -> tuple[dict[tuple[int, ...], float], float]:
    """({configuration: times}, lower bound): a fractional cover of `counts` (times each length, index = length)."""
    size = len(counts) - 1
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return {}, 0.0
    many, random = counts[lengths].astype(float), np.random.default_rng(seed)
    covered, times, bound = np.zeros(len(lengths)), defaultdict(float), 0.0
    for _ in range(rounds):
        prices = lengths * np.exp(covered.min() - covered)
        shaken = prices * np.exp(0.03 * random.standard_normal((SHAKEN, len(lengths))))
        shaken[0] = prices
        worth, last = knapsacks(shaken, lengths, size)
        best = worth[size, 0]
        bound = max(bound, float(prices @ many) / best)
        gained = np.zeros(len(lengths))
        for k in range(SHAKEN):
            for i in np.argsort(covered, kind="stable"):
                if gained[i] >= STEP or prices[i] + 1.05 * worth[size - lengths[i], k] < 0.98 * best:
                    continue
                used, often = np.unique([int(i), *_content(last[:, k], lengths, size - int(lengths[i]))], return_counts=True)
                taken = ((STEP - gained[used]) * many[used] / often).min()
                if taken > 0 and prices[used] @ often >= 0.98 * best:
                    times[tuple(np.repeat(lengths[used], often)[::-1].tolist())] += taken
                    gained[used] += taken * often / many[used]
        covered += gained
    least = covered[covered > 0].min()
    return {c: t / least for c, t in times.items()}, bound


def best_fit(left: np.ndarray, packed: dict[tuple[int, ...], int]) -> dict[tuple[int, ...], int]:
    """`packed` with the rest of the histogram put in: longest first, into the smallest gap that holds it."""
    size = len(left) - 1
    gaps: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    for content, many in packed.items():
        gaps[size - sum(content)][content] += many

    def put(content: tuple[int, ...], many: int, length: int, each: int) -> None:
        if many:
            now = content + (length,) * each
            gaps[size - sum(now)][now] += many

    for length in range(size, 0, -1):
        rest = int(left[length])
        for gap in sorted(g for g in gaps if g >= length):
            for content in list(gaps[gap]):
                if not rest:
                    break
                many, each = gaps[gap][content], gap // length
                full = min(many, rest // each)
                part = min(rest - full * each, each) if full < many else 0
                gaps[gap][content] -= full + (part > 0)
                if not gaps[gap][content]:
                    del gaps[gap][content]
                put(content, full, length, each)
                put(content, int(part > 0), length, part)
                rest -= full * each + part
            if not gaps[gap]:
                del gaps[gap]
        each = size // length
        put((), rest // each, length, each)
        put((), int(rest % each > 0), length, rest % each)
    out: dict[tuple[int, ...], int] = defaultdict(int)
    for contents in gaps.values():
        for content, many in contents.items():
            out[content] += many
    return out


def _rounded(counts: np.ndarray, times: dict[tuple[int, ...], float], scale: float) -> dict[tuple[int, ...], int]:
    left, packed = counts.copy(), {}
    for content, value in sorted(times.items(), key=lambda x: (-sum(x[0]), -x[1], x[0])):
        used, often = np.unique(content, return_counts=True)
        many = min(int(value / scale), int((left[used] // often).min()))
        if many:
            left[used] -= often * many
            packed[content] = many
    return best_fit(left, packed)


def configurations(counts: np.ndarray) -> tuple[dict[tuple[int, ...], int], float]:
    """({lengths of a sequence: number of such sequences}, lower bound on all of them) for a histogram of lengths.

    `counts[l]` pieces have length l; the last index is the size of a sequence. Takes time by the number of
    lengths, whatever the counts.
    """
    size = len(counts) - 1
    short = counts.copy()
    short[size] = 0
    times, bound = weighted_cover(short)
    best = min((_rounded(short, times, scale) for scale in SCALES), key=lambda p: sum(p.values()))
    full = int(counts[size])
    bound = max(bound, float(short @ np.arange(size + 1)) / size)
    return ({(size,): full} if full else {}) | dict(best), bound + full


@dataclass(frozen=True)
class Slots:
    """Where the pieces of each length go, by rank: rows sorted by (length, first rank). Bounded by the lengths."""

    keys: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces."""
        at = np.searchsorted(self.keys, (lengths.astype(np.int64) << _RANK_BITS) | ranks, side="right") - 1
        return self.sequence[at] + ranks - self.first[at], self.offset[at]


def slots(packed: dict[tuple[int, ...], int]) -> Slots:
    rows, ranks, sequence = [], defaultdict(int), 0
    for content, many in packed.items():
        offset = 0
        for length in content:
            rows.append((length, ranks[length], sequence, offset))
            ranks[length] += many
            offset += length
        sequence += many
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return Slots((table[:, 0] << _RANK_BITS) | table[:, 1], table[:, 1], table[:, 2], table[:, 3])


def _cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of `n` ids: whole ones but for the first."""
    head = n % size
    return ([(0, head)] if head else []) + [(s, size) for s in range(head, n, size)]


def _encoded(docs: DataFrame, tokenizer_file: str, end_id: int, size: int, special: bool, with_ids: bool) -> DataFrame:
    """The pieces of every document: what _PIECE names, and with `with_ids` the ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end, part = encoder_of(tokenizer_file, special), array("i", [end_id]).tobytes(), TaskContext.get().partitionId()
        seen = [0] * (size + 1)
        try:
            for batch in batches:
                for doc_ids, texts in _slices(batch):
                    rows, held = [], []
                    for doc_id, text in zip(doc_ids, texts, strict=True):
                        ids = encoder.encode(text) + end
                        for piece, (start, length) in enumerate(_cuts(len(ids) // 4, size)):
                            data = ids[4 * start : 4 * (start + length)]
                            rows.append((part, doc_id, piece, start, length, zlib.crc32(data), seen[length]))
                            held.append(data)
                            seen[length] += 1
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                    if with_ids:
                        ends = np.cumsum([0] + [len(h) // 4 for h in held]).astype(np.int32)
                        columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(held), dtype="<i4"))))
                    yield pa.RecordBatch.from_arrays(columns, names=names)
        finally:
            encoder.trim()

    types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    fields = _PIECE + (", ids array<int>" if with_ids else "")
    names = [f.split()[0] for f in fields.split(", ")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(read, fields)


def pack(docs: DataFrame, tokenizer_file: str, size: int = SIZE, end_id: int = END_ID, special: bool = True, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of `docs` (doc_id, text), and its `ids` if asked for.

    A document is the ids of its text and `end_id`; more than `size` are cut into pieces of `size`, of which the
    first may be shorter. Null texts are empty: their piece is the end id alone. Repeated rows are packed each,
    null ids are kept, other columns are ignored, no rows give none. sequence_id counts from 0 and the pieces of
    a sequence follow each other without gaps. With `special`, what spells a special token is that token, as
    the library takes it by default. The pieces are written to the shared folder once, so ranks hold whatever is lost.
    """
    ship_package(docs.sparkSession)
    pieces = stored(_encoded(docs, tokenizer_file, end_id, size, special, with_ids), "pieces")
    sizes = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = np.zeros(size + 1, dtype=np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("n")).collect():  # at most `size` rows
        counts[length] = n
    known = docs.sparkSession.sparkContext.broadcast(slots(configurations(counts)[0]))
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    before = sizes.select("part", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(lengths, ranks):
        import pandas as pd

        sequence, offset = known.value.place(lengths.to_numpy(), ranks.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("at", placed("length", "rank")).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "at.sequence_id", "at.offset", *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the sequences of `pack(..., with_ids=True)`, each of at most `size` ids."""
    grouped = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("found"))
    ids = F.flatten(F.transform("found", lambda x: x["ids"]))
    return grouped.select("sequence_id", ids.alias("ids")).select("sequence_id", F.size("ids").alias("length"), "ids")
