"""Embedding whitening by bit-sliced scatter: exact covariances from AND-popcounts.

An entry c becomes the whole number floor(256 c). Every distinct vector of whole numbers counts once. A task
shifts a block of them to start at zero in each dimension and packs every bit plane of every dimension across
the rows into 64-bit words. The sum of products of two dimensions is then the sum over pairs of planes of
2^(a+b) times the number of bits set in both, and the shifts are put back as whole numbers. Sums leave a task
as limbs of LIMB bits, so they stay exact however many rows there are; n * products - sums * sums is formed
from whole numbers and only the quotient is rounded. What reaches the driver depends on the dimensions
alone, never on the rows: one matrix, from which `eigh` takes the components.

A vector shorter than the longest is taken as followed by zeros. A number beyond a long is the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from signpost.session import ship_package, stored

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 8192
LIMB = 40
_LONG = np.iinfo(np.int64)


def _groups(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, whole numbers as a matrix) of the lists without null or non-finite entries, by length."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets, values = lists.offsets.to_numpy().astype(np.int64), lists.values
    entries = values.to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become nan
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(entries))))
    good = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
    sizes = np.diff(offsets)
    for size in np.unique(sizes[good]):
        rows = np.flatnonzero(good & (sizes == size))
        found = entries[offsets[rows][:, None] + np.arange(size)]
        with np.errstate(over="ignore"):
            whole = np.floor(SCALE * found)
        high, low = whole >= 2.0**63, whole < -(2.0**63)
        numbers = np.where(high | low, 0.0, whole).astype(np.int64)
        numbers[high], numbers[low] = _LONG.max, _LONG.min
        yield rows, numbers


def _packed(numbers: np.ndarray) -> pa.Array:
    """Rows of whole numbers as bytes: their width (1, 2, 4 or 8, the least that holds the row), then the numbers."""
    rows, size = numbers.shape
    most = np.maximum(numbers.max(axis=1, initial=0), ~numbers.min(axis=1, initial=0))
    widths = np.select([most < 1 << 7, most < 1 << 15, most < 1 << 31], [1, 2, 4], 8)
    parts = []
    for width in np.unique(widths):
        held = numbers[widths == width].astype(f"<i{width}")
        data = np.empty((len(held), 1 + size * width), dtype=np.uint8)
        data[:, 0] = width
        data[:, 1:] = held.view(np.uint8).reshape(len(held), -1)
        ends = np.arange(len(held) + 1, dtype=np.int32) * data.shape[1]
        parts.append(pa.Array.from_buffers(pa.binary(), len(held), [None, pa.py_buffer(ends), pa.py_buffer(data)]))
    return pa.concat_arrays(parts)


def _unpacked(codes: pa.Array) -> Iterator[np.ndarray]:
    """Matrices of whole numbers, by width and length."""
    if not len(codes):
        return
    ends = np.frombuffer(codes.buffers()[1], dtype=np.int32)[codes.offset : codes.offset + len(codes) + 1].astype(np.int64)
    data = np.frombuffer(codes.buffers()[2], dtype=np.uint8) if codes.buffers()[2] else np.zeros(0, np.uint8)
    sizes, widths = np.diff(ends), data[ends[:-1]]
    for width, size in np.unique(np.stack([widths, sizes], axis=1), axis=0):
        rows = np.flatnonzero((widths == width) & (sizes == size))
        body = data[ends[rows][:, None] + np.arange(1, size)]
        yield np.ascontiguousarray(body).view(f"<i{width}").astype(np.int64).reshape(len(rows), -1)


def scatter(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, sums of products for i <= j) over the rows of a block, as Python integers, from its bit planes."""
    rows, size = numbers.shape
    low = numbers.min(axis=0)
    shifted = numbers.view(np.uint64) - low.view(np.uint64)
    bits = int(shifted.max(initial=0)).bit_length()
    padded = np.zeros((-(-rows // 64) * 64, size), dtype=np.uint64)
    padded[:rows] = shifted
    planes = np.stack([np.packbits((padded >> np.uint64(b) & np.uint64(1)).astype(np.uint8), axis=0) for b in range(bits)], axis=1) if bits else np.zeros((len(padded) // 8, 0, size), np.uint8)
    words = np.ascontiguousarray(planes.transpose(2, 1, 0)).view(np.uint64)  # dimension, bit, word
    exact = np.int64 if 2 * bits + rows.bit_length() <= 62 else object
    weights = np.array([1 << b for b in range(bits)], dtype=exact)
    sums = (np.bitwise_count(words).sum(axis=2, dtype=np.int64).astype(exact) @ weights).astype(object) if bits else np.zeros(size, dtype=object)
    products = np.zeros((size, size), dtype=object)
    for i in range(size if bits else 0):
        total = np.zeros(size - i, dtype=exact)
        for a in range(bits):
            both = np.bitwise_count(words[i, a] & words[i:]).sum(axis=2, dtype=np.int64)
            total = total + (both.astype(exact) @ weights) * weights[a]
        products[i, i:] = total
    shift = low.astype(object)
    products = products + np.outer(sums, shift) + np.outer(shift, sums) + rows * np.outer(shift, shift)
    return sums + rows * shift, products


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, value, k = (-1 if value < 0 else 1), abs(int(value)), 0
    while value:
        if part := value & ((1 << LIMB) - 1):
            yield k, sign * part
        value >>= LIMB
        k += 1


def _sums(fit: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, sums of products) over the distinct vectors: one bounded table of limbs, added up by Spark."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(0, dtype=object), np.zeros((0, 0), dtype=object)
        waiting: dict[int, list[np.ndarray]] = {}

        def add(block: np.ndarray) -> None:
            nonlocal n, sums, products
            size = block.shape[1]
            if size > len(sums):
                old_sums, old_products = sums, products
                sums, products = np.zeros(size, dtype=object), np.zeros((size, size), dtype=object)
                sums[: len(old_sums)], products[: len(old_sums), : len(old_sums)] = old_sums, old_products
            s, p = scatter(block)
            n += len(block)
            sums[: len(s)] += s
            products[: len(s), : len(s)] += p

        for batch in batches:
            for numbers in _unpacked(batch.column(0)):
                held = waiting.setdefault(numbers.shape[1], [])
                held.append(numbers)
                if sum(map(len, held)) >= BLOCK_ROWS:
                    rows = np.concatenate(held)
                    for a in range(0, len(rows), BLOCK_ROWS):
                        add(rows[a : a + BLOCK_ROWS])
                    held.clear()
        for held in waiting.values():
            if held:
                add(np.concatenate(held))
        if not n:
            return
        out = [(-1, -1, 0, n)] + [(-1, i, 0, 0) for i in range(len(sums))]
        out += [(-1, i, k, v) for i, s in enumerate(sums) for k, v in _limbs(s)]
        out += [(i, j, k, v) for i in range(len(sums)) for j in range(i, len(sums)) for k, v in _limbs(products[i, j])]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["i", "j", "limb", "value"])

    limbs = fit.mapInArrow(read, "i int, j int, limb int, value long").groupBy("i", "j", "limb").agg(F.sum("value").alias("value"))
    found: dict[tuple[int, int], int] = {}
    for i, j, limb, value in limbs.collect():
        found[i, j] = found.get((i, j), 0) + (value << LIMB * limb)
    size = 1 + max((j for i, j in found if i == -1), default=-1)
    return found.get((-1, -1), 0), [found[-1, i] for i in range(size)], [[found.get((min(i, j), max(i, j)), 0) for j in range(size)] for i in range(size)]


@dataclass(frozen=True)
class Whitening:
    """What a table of vectors gives: n distinct ones, their sums, and the components by falling eigenvalue.

    `scales[k]` is one over the root of eigenvalue k, nan where the vectors have no spread along component k.
    """

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    scales: np.ndarray
    trace: float

    def deviations(self, numbers: np.ndarray) -> np.ndarray:
        """n * x - sums, exact; as Python integers where a square might not fit a long."""
        size = numbers.shape[1]
        most = max(int(numbers.max(initial=0)), -int(numbers.min(initial=0)), 1)
        far = self.n * most + max((abs(s) for s in self.sums), default=0)
        exact = np.int64 if far * far * max(len(self.sums), 1) < 1 << 63 else object
        out = np.zeros((len(numbers), len(self.sums)), dtype=exact)
        out[:, :size] = numbers.astype(exact) * self.n
        return out - np.array(self.sums, dtype=exact)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations.astype(np.float64) / self.n) @ self.components * self.scales


def _solved(n: int, sums: list[int], products: list[list[int]], components: int) -> Whitening:
    size = len(sums)
    spread = np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in range(size)] for i in range(size)]).reshape(size, size)
    values, vectors = np.linalg.eigh(spread) if size else (np.zeros(0), np.zeros((0, 0)))
    kept = min(components, size)
    values, vectors = values[::-1], vectors[:, ::-1]
    flat = values <= max(values.max(initial=0.0), 0.0) * size * np.finfo(float).eps
    scales = np.where(flat, np.nan, 1 / np.sqrt(np.where(flat, 1.0, values)))
    return Whitening(n, sums, values[:kept], np.ascontiguousarray(vectors[:, :kept]), scales[:kept], float(np.trace(spread)))


def distinct_numbers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(code): every distinct vector of whole numbers once, packed; written to the shared folder.

    Equal vectors are merged before the shuffle already, so one that fills a third of the table costs a row a task.
    """
    ship_package(vectors.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, numbers in _groups(batch.column(0)):
                yield pa.RecordBatch.from_arrays([_packed(numbers)], names=["code"])

    codes = vectors.select(F.col(column).cast("array<double>").alias("v")).mapInArrow(read, "code binary")
    return stored(codes.distinct(), "vectors")


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Components of the distinct vectors of `distinct_numbers`."""
    return _solved(*_sums(distinct), components)


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened distinct vectors' covariance minus the identity; None without spread.

    Measured over all of them: Spark's covar_pop centres before it multiplies.
    """
    known = distinct.sparkSession.sparkContext.broadcast(model)
    spread = [k for k in range(len(model.values)) if np.isfinite(model.scales[k])]
    if not spread:
        return None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers in _unpacked(batch.column(0)):
                found = known.value.whitened(known.value.deviations(numbers))
                yield pa.RecordBatch.from_arrays([pa.array(found[:, k]) for k in spread], names=[f"w{k}" for k in spread])

    rows = distinct.mapInArrow(read, ", ".join(f"w{k} double" for k in spread))
    pairs = [(a, b) for a in spread for b in spread if a <= b]
    row = rows.agg(*[F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(value - (a == b)) for value, (a, b) in zip(row, pairs, strict=True))


def whiten(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Vectors that are null or hold null or non-finite entries are left out. Repeated rows all come out, but count
    once in the estimate. deviation is the sum over dimensions of (n x - sums)^2, null beyond a long. whitened is
    null for a component along which the vectors do not differ (explained is then 0, or null if they differ along
    none). Fewer dimensions than `components` give fewer rows; no vectors or empty ones give none. Null ids
    are kept and other columns ignored.
    """
    distinct = distinct_numbers(vectors, column)
    model = fit(distinct, components)
    error = identity_error(distinct, model)
    known = vectors.sparkSession.sparkContext.broadcast((model, error))
    kind = vectors.schema[id_column].dataType
    id_type, size = to_arrow_type(kind), len(model.values)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, error = known.value
        explained = model.values / model.trace if model.trace > 0 else np.full(size, np.nan)
        flat = ~np.isfinite(model.scales)
        for batch in batches:
            for rows, numbers in _groups(batch.column(1)):
                away = model.deviations(numbers)
                squares = [int(s) for s in (away * away).sum(axis=1)]
                whitened = model.whitened(away)
                many = len(rows) * size
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(rows, size))).cast(id_type), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(many, model.n, dtype=np.int64)),
                    pa.array([s if s <= _LONG.max else None for s in squares for _ in range(size)], pa.int64()),
                    pa.array(whitened.ravel(), mask=np.tile(flat, len(rows))), pa.array(np.tile(explained, len(rows)), from_pandas=True),
                    pa.array([error] * many, pa.float64())], names=names)

    names = [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    fields = f"`{id_column}` {kind.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return vectors.select(F.col(id_column), F.col(column).cast("array<double>").alias("_vector")).mapInArrow(read, fields)
