"""Quality classifier: Naive Bayes support vectors fitted by dual coordinate descent.

Features are indicators of n-grams, hashed: single words, and runs of one to three token shapes (case of
a word, digits, the punctuation mark itself, and whether a token repeats the one before). Each indicator
is scaled by the log ratio of its smoothed shares in the two classes, a linear hinge-loss model is fitted
on the scaled indicators, and its margin becomes a score by logistic calibration on rows it has not seen.

Labels are learned from a bounded sample of SAMPLE rows; the sampled features are fitted on the driver,
where they take a fixed amount of memory. The weights, 2**HASH_BITS numbers, go to every task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signpost.llm.language import held_out
from signpost.session import ship_package

SAMPLE = 12_000  # labelled documents learned from, at most
HASH_BITS = 18
THRESHOLD = 0.7
SMOOTHING = 1.0
COST = 0.05
ROUNDS = 12
CALIBRATION = 4  # every fourth sampled row calibrates

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_REPEAT = 64


class Tokens(dict):
    """token -> (shape, hash), remembered up to a bound."""

    LIMIT = 500_000

    def __missing__(self, token: str) -> tuple[int, int]:
        if token.isalpha():
            shape = 0 if token.islower() else 1 if token[1:].islower() or len(token) == 1 else 2 if token.isupper() else 3
        elif token.isdigit():
            shape = 4
        else:
            shape = 5 + sum(token.encode()) % 59
        value = (shape, _stable(token.lower()))
        if len(self) >= self.LIMIT:
            self.clear()
        self[token] = value
        return value


def _stable(token: str) -> int:
    value = 1469598103934665603
    for byte in token.encode():
        value = (value ^ byte) * 1099511628211 & 0xFFFFFFFFFFFFFFFF
    return value


def features(text: str | None, tokens: Tokens, bits: int = HASH_BITS) -> np.ndarray:
    """Sorted distinct feature numbers of one whole text."""
    found = _TOKEN.findall(text or "")
    if not found:
        return np.empty(0, dtype=np.int32)
    pairs = np.array([tokens[t] for t in found], dtype=np.uint64)
    words = pairs[:, 1]
    shapes = pairs[:, 0].copy()
    shapes[1:] += np.uint64(_REPEAT) * (words[1:] == words[:-1])
    one = shapes + np.uint64(1)
    parts = [words, one]
    if len(one) > 1:
        two = one[:-1] * np.uint64(131) + one[1:]
        parts.append(two + np.uint64(1 << 20))
        if len(one) > 2:
            parts.append(two[:-1] * np.uint64(131) + one[2:] + np.uint64(1 << 40))
    mixed = np.concatenate([np.unique(p) for p in parts]) * _MIX
    return np.unique((mixed >> np.uint64(64 - bits)).astype(np.int32))


@dataclass
class Model:
    weights: np.ndarray  # scaled: one lookup per feature
    bias: float
    slope: float
    shift: float

    def score(self, row: np.ndarray) -> float:
        margin = float(self.weights[row].sum()) / np.sqrt(max(len(row), 1)) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40))))


def _descend(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, rounds: int, cost: float) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss over the scaled indicators (unit length per sqrt of its size) and a bias."""
    values = [ratio[r] / np.sqrt(max(len(r), 1)) for r in rows]
    norms = np.array([float(v @ v) + 1.0 for v in values])
    weights, bias, dual = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    order, generator = np.arange(len(rows)), np.random.default_rng(7)
    for _ in range(rounds):
        generator.shuffle(order)
        moved = 0.0
        for i in order:
            gap = labels[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(dual[i] - gap / norms[i], 0.0), cost)
            step = (new - dual[i]) * labels[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                dual[i] = new
        if moved < 1e-6:
            break
    return weights, bias


def _calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the margins, by Newton steps with a weak prior on a slope of 1."""
    beta = np.array([1.0, 0.0])
    points = np.column_stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(points @ beta, -40, 40)))
        slope = points.T @ (p - (labels > 0)) + 0.01 * (beta - [1.0, 0.0])
        curve = (points * (p * (1 - p))[:, None]).T @ points + 0.01 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit(rows: list[np.ndarray], good: np.ndarray, bits: int = HASH_BITS, rounds: int = ROUNDS, cost: float = COST) -> Model:
    """The model of feature rows and their labels (True is good). Without both classes the score is the share of good rows."""
    share = (good.sum() + 1) / (len(good) + 2)
    if good.all() or not good.any():
        return Model(np.zeros(1 << bits, dtype=np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    test = np.arange(len(rows)) % CALIBRATION == 0
    if good[~test].all() or not good[~test].any() or good[test].all() or not good[test].any():
        test = np.ones(len(rows), dtype=bool)
        train = test
    else:
        train = ~test
    learned = [r for r, t in zip(rows, train, strict=True) if t]
    labels = np.where(good[train], 1.0, -1.0)
    shares = []
    for sign in (1.0, -1.0):
        own = [r for r, y in zip(learned, labels, strict=True) if y == sign]
        counts = np.bincount(np.concatenate(own), minlength=1 << bits) + SMOOTHING
        # share of documents, so that classes of any size weigh alike
        shares.append(counts / (len(own) + 2 * SMOOTHING))
    ratio = np.log(shares[0] / shares[1])
    weights, bias = _descend(learned, labels, ratio, rounds, cost)
    model = Model((weights * ratio).astype(np.float32), bias, 1.0, 0.0)
    margins = np.array([float(model.weights[r].sum()) / np.sqrt(max(len(r), 1)) + bias for r, t in zip(rows, test, strict=True) if t])
    model.slope, model.shift = _calibrate(margins, np.where(good[test], 1.0, -1.0))
    return model


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = HASH_BITS) -> Model:
    """Fit on at most `sample` rows of `labels` (doc_id, quality) that are not held out, with their texts."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def numbers(texts: pd.Series) -> pd.Series:
        tokens = Tokens()
        return pd.Series([features(t, tokens, bits) for t in texts], dtype=object)

    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    draw = F.xxhash64("doc_id", F.lit("quality sample"))
    # one label per document; rows beyond the sample never leave their task
    chosen = usable.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(draw, "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", numbers("text").alias("row"))
    single = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("row").alias("row"))
    table = single.toArrow().sort_by([("doc_id", "ascending")])  # at most `sample` rows
    found = [np.asarray(r, dtype=np.int64) for r in table["row"].to_numpy()] if len(table) else []
    return fit(found, table["quality"].to_numpy().astype(int) == 1, bits)


def score(docs: DataFrame, model: Model, bits: int = HASH_BITS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs` (doc_id, text); only the text is looked at.

    Null and empty texts have no features and get the score of the bias.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        tokens, known = Tokens(), sent.value
        return pd.Series([known.score(features(t, tokens, bits)) for t in texts], dtype="float64")

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def rate(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Learn from `labels` and score every row of `docs`."""
    return score(docs, learn(docs, labels, sample))
