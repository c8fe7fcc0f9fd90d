"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Every document that passes the base rules becomes a vector of transformed text statistics. For each
(language, source), each language and the whole corpus the minimum-covariance-determinant estimate is
found by concentration steps over all its rows: start from coordinate medians and median deviations,
keep the share `CORE` of rows with the smallest Mahalanobis distance, re-estimate, and repeat until the
determinant stops falling. Distances are scaled so that their median is that of chi-square. A document
is judged by the finest of its three groups that has `MIN_ROWS` rows, and rejected if its squared
distance exceeds the chi-square quantile of `TAIL`.

A coordinate in which more than half of a group's rows are equal has no spread to estimate; there the
floor of VECTOR is added to its variance. All others get the variance of rounding only.

Coordinates are whole numbers (units of 1/SCALE) and distances are compared in logarithmic bins, so
medians, order statistics and sums are exact and do not depend on partitioning. Everything a group
adds up is reduced map-side; matrices are inverted where the group's row lies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost.llm.rows import whole_row
from signpost.session import cut, ship_package

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5

SCALE = 256
CORE = 0.75
FALL = 1e-3  # a smaller fall of the determinant's logarithm ends the steps
MIN_ROWS = 200
TAIL = 1e-4
BINS = 64
ROUNDING = 1 / (12 * SCALE**2)  # variance of rounding to a coordinate's unit
GROUPS_SENT = 100_000  # rows of about 300 bytes
# transformed statistics and the spread taken where most texts of a group are equal
VECTOR = {"long": 1.5, "wide": 0.08, "marked": 0.5, "doubled": 0.9, "echoed": 0.9, "capital": 0.6}
NAMES = list(VECTOR)
_PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i, len(NAMES))]

_SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
_CAPITALS = bytes(range(65, 91))
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def repeated_words(found: list[bytes], width: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of `width` words found twice or more in the text."""
    windows = list(zip(*(found[i:] for i in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: set = set()
    twice = {w for w in windows if w in seen or seen.add(w)}
    total = end = 0
    for i, window in enumerate(windows):
        if window in twice:
            total += i + width - max(i, end)
            end = i + width
    return total


def text_counts(text: bytes | None) -> tuple[int, ...]:
    """The counts of `_COUNTS` over one whole text (UTF-8; None has no words)."""
    text = text or b""
    found = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    chars = b"".join(found)
    return (
        len(found), len(chars.translate(None, _CONTINUATION)), len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(found), len(lines), len(text) - len(text.translate(None, _CAPITALS)))


def _vector() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))

    def percent(part: Column, whole: Column) -> Column:
        return F.log1p(100 * part / (whole + 10))

    values = {
        "long": F.log1p("n_words"),
        # short texts are pulled towards the usual width, as a few words say little
        "wide": F.log((F.col("word_chars") + 150) / (words + 30)),
        "marked": percent(F.col("n_symbols"), words),
        "doubled": percent(F.col("n_dup_lines"), F.col("n_lines")),
        "echoed": percent(F.col("n_repeat_words"), words),
        "capital": F.log((F.col("n_capitals") + 2.5) / (words + 30)),
    }
    return [F.round(values[n] * SCALE).cast("long").alias(n) for n in NAMES]


def chi_square(p: float, degrees: int) -> float:
    """Quantile by the cube-root normal approximation of Wilson and Hilferty."""
    z, k = NormalDist().inv_cdf(p), 2 / (9 * degrees)
    return degrees * (1 - k + z * math.sqrt(k)) ** 3


def _groups() -> Column:
    """The three groups of a row, finest first."""
    lang = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))
    source = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    return F.array(F.concat(F.lit("0"), lang, F.lit("\x1f"), source), F.concat(F.lit("1"), lang), F.lit("2"))


def _distance() -> Column:
    """Squared Mahalanobis distance of the row from its group's centre."""
    gap = {i: F.col(n) / SCALE - F.col("centre")[i] for i, n in enumerate(NAMES)}
    terms = [gap[i] * gap[j] * F.col("inverse")[k] * (1 if i == j else 2) for k, (i, j) in enumerate(_PAIRS)]
    return sum(terms[1:], terms[0])


def _bin(distance: Column) -> Column:
    return F.round(F.log2(F.greatest(distance, F.lit(0.0)) + 1e-3) * BINS).cast("int")


def _inverted(groups: DataFrame) -> DataFrame:
    """(grp, centre, inverse, floors, det, falling) from (grp, n, sums, products, floors, before) over whole-number coordinates."""

    def invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            centres, inverses, dets = [], [], []
            for n, sums, products, floors in zip(batch["n"], batch["sums"], batch["products"], batch["floors"], strict=True):
                centre = np.array(sums, dtype=float) / n / SCALE
                spread = np.zeros((len(NAMES), len(NAMES)))
                for (i, j), value in zip(_PAIRS, products, strict=True):
                    spread[i, j] = spread[j, i] = value / n / SCALE**2 - centre[i] * centre[j]
                spread += np.diag(floors)
                inverse = np.linalg.inv(spread)
                dets.append(float(np.linalg.slogdet(spread)[1]))
                centres.append(centre.tolist())
                inverses.append([float(inverse[i, j]) for i, j in _PAIRS])
            falling = np.array(dets) < batch["before"].to_numpy() - FALL
            yield pd.DataFrame({"grp": batch["grp"], "centre": centres, "inverse": inverses, "floors": batch["floors"], "det": dets, "falling": falling})

    return groups.mapInPandas(invert, "grp string, centre array<double>, inverse array<double>, floors array<double>, det double, falling boolean")


def _start(rows: DataFrame, send) -> DataFrame:
    """(grp, centre, inverse, floors, det): coordinate medians and median absolute deviations; no determinant yet."""
    middle = rows.groupBy("grp").agg(*[F.percentile(n, 0.5).alias(f"m_{n}") for n in NAMES])
    away = rows.join(send(middle), "grp").groupBy("grp").agg(
        *[F.first(f"m_{n}").alias(f"m_{n}") for n in NAMES], *[F.percentile(F.abs(F.col(n) - F.col(f"m_{n}")), 0.5).alias(f"d_{n}") for n in NAMES])
    floors = [F.when(F.col(f"d_{n}") > 0, F.lit(ROUNDING)).otherwise(F.lit(f * f)) for n, f in VECTOR.items()]
    spread = [1 / (F.pow(1.4826 * F.col(f"d_{NAMES[i]}") / SCALE, F.lit(2)) + floors[i]) if i == j else F.lit(0.0) for i, j in _PAIRS]
    return away.select(
        "grp", F.array(*[F.col(f"m_{n}") / SCALE for n in NAMES]).alias("centre"), F.array(*spread).alias("inverse"), F.array(*floors).alias("floors"),
        F.lit(float("inf")).alias("det"))


def robust_estimates(rows: DataFrame, send=lambda groups: groups, core: float = CORE) -> DataFrame:
    """(grp, centre, inverse, stretch) of every `grp` in `rows` (grp and the coordinates of VECTOR).

    `send` marks tables of one row per group that are known to be small enough to go to every task.
    """
    open_, settled = cut(_start(rows, send)), []
    while not settled or not open_.isEmpty():
        away = rows.join(send(open_.select("grp", "centre", "inverse")), "grp").select("grp", *NAMES, _bin(_distance()).alias("bin"))
        limit = away.groupBy("grp").agg(F.percentile("bin", core).alias("limit"))
        kept = away.join(send(limit), "grp").filter("bin <= limit")
        sums = kept.groupBy("grp").agg(
            F.count(F.lit(1)).alias("n"), F.array(*[F.sum(n) for n in NAMES]).alias("sums"),
            F.array(*[F.sum(F.col(NAMES[i]) * F.col(NAMES[j])) for i, j in _PAIRS]).alias("products"))
        step = cut(_inverted(sums.join(send(open_.select("grp", "floors", F.col("det").alias("before"))), "grp")))
        settled.append(step.filter("NOT falling"))
        open_ = step.filter("falling")
    estimate = cut(reduce(DataFrame.union, settled).select("grp", "centre", "inverse", "floors"))
    # the core is narrower than the whole: scale distances so that their median is that of chi-square over the coordinates that have a spread
    away = rows.join(send(estimate), "grp").groupBy("grp").agg(F.percentile(_bin(_distance()), 0.5).alias("half"))
    halves = F.array(F.lit(None).cast("double"), *[F.lit(chi_square(0.5, k)) for k in range(1, len(NAMES) + 1)])
    half = halves[F.size(F.filter("floors", lambda f: f == ROUNDING))]
    stretch = F.coalesce(F.pow(F.lit(2.0), F.col("half") / BINS) / half, F.lit(1.0))
    return cut(estimate.join(away, "grp").select("grp", "centre", "inverse", stretch.alias("stretch")))


def _counted(docs: DataFrame, *keep: str) -> DataFrame:
    """`keep` of `docs`, the counts, base_failed, the coordinates and the groups of every row."""
    ship_package(docs.sparkSession)

    @F.pandas_udf(", ".join(f"{c} long" for c in _COUNTS))
    def counted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_counts(t) for t in texts], columns=_COUNTS, dtype="int64")

    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    read = docs.select(*keep, _groups().alias("grps"), counted(F.col("text").cast("binary")).alias("c"))
    return read.select(*keep, "grps", "c.*").withColumn("base_failed", base).select("*", *_vector())


def _judges(rows: DataFrame, min_rows: int) -> DataFrame:
    """(own, e): for each (language, source), the estimate of the finest of its groups that is large enough."""
    judged = rows.filter(~F.col("base_failed"))
    spread = judged.select(F.explode("grps").alias("grp"), *NAMES)
    sizes = spread.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    large = cut(sizes.filter((F.col("n") >= min_rows) | (F.col("grp") == "2")).select("grp"))
    send = F.broadcast if large.count() <= GROUPS_SENT else lambda groups: groups
    estimates = robust_estimates(cut(spread.join(send(large), "grp")), send)
    # which of the three groups judges a (language, source) is settled once per group, not per row
    combos = judged.select("grps").distinct().select(F.col("grps")[0].alias("own"), F.posexplode("grps").alias("level", "grp"))
    chosen = combos.join(estimates, "grp").groupBy("own").agg(F.min_by(F.struct("centre", "inverse", "stretch"), "level").alias("e"))
    chosen = cut(chosen)
    return F.broadcast(chosen) if chosen.count() <= GROUPS_SENT else chosen


def _verdict(rows: DataFrame, judges: DataFrame, tail: float, *keep: str) -> DataFrame:
    measured = rows.withColumn("own", F.col("grps")[0]).join(judges, "own", "left").select(
        *keep, *_COUNTS, "base_failed", *NAMES, F.col("e.centre").alias("centre"), F.col("e.inverse").alias("inverse"), F.col("e.stretch").alias("stretch"))
    distance = F.when(~F.col("base_failed"), _distance() / F.col("stretch"))
    good = ~F.col("base_failed") & (F.col("distance") <= chi_square(1 - tail, len(NAMES)))
    return measured.select(*keep, *_COUNTS, "base_failed", distance.alias("distance")).withColumn("kept", good)


def judge(docs: DataFrame, min_rows: int = MIN_ROWS, tail: float = TAIL) -> DataFrame:
    """(doc_id, counts, base_failed, distance, kept) for every row of `docs` (doc_id, text, lang, source).

    Null texts have no words and fail the base rules. Null languages and sources are groups of their own.
    `distance` is null where the base rules failed. Other columns are ignored; repeated rows are judged alike.
    """
    rows = cut(_counted(docs, "doc_id"))
    return _verdict(rows, _judges(rows, min_rows), tail, "doc_id")


def keep_good(docs: DataFrame, min_rows: int = MIN_ROWS, tail: float = TAIL) -> DataFrame:
    """The rows of `docs`, with its columns, that `judge` keeps.

    The estimates go to the rows, so texts are counted twice but neither shuffled nor written. Repeated rows are
    judged alike; no rows give none; columns may have any names.
    """
    judges = _judges(cut(_counted(docs)), min_rows)
    held = docs.select(whole_row(docs), "text", "lang", "source")
    return _verdict(_counted(held, "_doc"), judges, tail, "_doc").filter("kept").select("_doc.*")
