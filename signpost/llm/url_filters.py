"""URL filters: a short rule list by longest match, and a listed-key set as a Bloom filter cascade.

The cascade answers membership of a listed key exactly for every key the corpus can ask for: the first
filter holds the listed keys, the second the other corpus keys that the first lets through, the third
the listed keys that the second lets through, and so on until nothing is left over. A key belongs to
the list if the first level that rejects it is an even one. The levels go to every task as one bit
string each, so urls are judged where they lie, without a join; the bits are found and set by Spark.

The first level is made so sparse that it lets through fewer corpus keys than there are listed ones;
the others pass a tenth. All levels together then take some 1.44 log2(corpus keys / listed keys) + 10
bits for each listed key that occurs: a size that follows the list. If a level would exceed `max_bits`,
nothing is sent and the list is joined instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost.session import cut, ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PASSED = 0.1
MAX_BITS = 1 << 31  # 256 MB a level

# fixed values: the rule list, (verdict, rule), rule = host and the start of a path
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): both empty for null urls and urls without ://; A-Z of the host lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule whose host is the url's or a parent of it and whose path starts the url's."""
    rule = verdict = F.lit(None).cast("string")
    # the longest is asked first; of equally long ones the longer host, then a block
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"), r[0] == "block")):
        name, start = text[: text.index("/")], text[text.index("/") :]
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def candidate_keys(host: Column, path: Column) -> Column:
    """What a list may hold of a url: the host, its parents, and each of these with the whole path."""
    labels = F.split(host, r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = F.when(F.length(host) > 0, above).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(hosts, F.transform(hosts, lambda h: F.concat(h, path))))


def _hashes(key: Column, level: int) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(2 * level), key), F.xxhash64(F.lit(2 * level + 1), key)


def _positions(first: np.ndarray, second: np.ndarray, bits: int, hashes: int) -> np.ndarray:
    steps = np.arange(hashes, dtype=np.uint64)
    return (first.view(np.uint64)[:, None] + steps * (second.view(np.uint64)[:, None] | np.uint64(1))) % np.uint64(bits)


@dataclass
class Level:
    bits: int
    hashes: int
    filled: Broadcast  # bytes

    def holds(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        table = np.frombuffer(self.filled.value, dtype=np.uint8)
        at = _positions(first, second, self.bits, self.hashes)
        return (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(axis=1)


def _shape(n: int, passed: float) -> tuple[int, int]:
    """(bits, hashes) of a filter of `n` keys that lets through the share `passed` of others."""
    per_key = -math.log(passed) / math.log(2) ** 2
    return max(64, -(-int(n * per_key) // 64 + 1) * 64), max(1, round(per_key * math.log(2)))


def _level(keys: DataFrame, level: int, bits: int, hashes: int) -> Level:
    """The filter of one level: tasks set the bits of their keys, words of equal place are combined in Spark."""

    @F.pandas_udf("array<struct<word:long,mask:long>>")
    def words(first: pd.Series, second: pd.Series) -> pd.Series:
        at = _positions(first.to_numpy(np.int64), second.to_numpy(np.int64), bits, hashes)
        masks = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
        return pd.Series([[{"word": int(w), "mask": int(m)} for w, m in zip(ws, ms, strict=True)] for ws, ms in zip(at >> np.uint64(6), masks, strict=True)], dtype=object)

    found = keys.select(F.inline(words(*_hashes(F.col("key"), level)))).groupBy("word").agg(F.expr("bit_or(mask)").alias("mask"))
    table = np.zeros(bits // 64, dtype=np.int64)
    for batch in found.toArrow().to_batches():  # at most bits / 64 rows
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return Level(bits, hashes, keys.sparkSession.sparkContext.broadcast(table.tobytes()))


def _let_through(level: Level):
    @F.pandas_udf("boolean")
    def holds(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series(level.holds(first.to_numpy(np.int64), second.to_numpy(np.int64)))

    return holds


def cascade(listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS) -> list[Level] | None:
    """Levels that tell every `key` of `universe` that `listed` has from every one it has not.

    Both have one column `key`, not null. Only listed keys the corpus asks for are encoded. None if a
    level would need more than `max_bits`.
    """
    ship_package(universe.sparkSession)
    keys = universe.distinct().join(listed.distinct().withColumn("on", F.lit(True)), "key", "left")
    keys = cut(keys.select("key", F.coalesce("on", F.lit(False)).alias("on")))
    inside, outside, levels = keys.filter("on").select("key"), keys.filter("NOT on").select("key"), []
    passed = min(PASSED, inside.count() / math.sqrt(2) / max(outside.count(), 1) or PASSED)
    while n := inside.count():
        bits, hashes = _shape(n, passed)
        if bits > max_bits:
            return None
        levels.append(_level(inside, len(levels), bits, hashes))
        wrong = cut(outside.filter(_let_through(levels[-1])(*_hashes(F.col("key"), len(levels) - 1))))
        inside, outside, passed = wrong, inside, PASSED
    return levels


def listed_keys(keys: Column, levels: list[Level]) -> Column:
    """The listed ones of an array of keys of the universe, exactly."""
    if not levels:
        return F.array().cast("array<string>")

    @F.pandas_udf("array<boolean>")
    def on_list(hashes: pd.Series) -> pd.Series:
        sizes = np.array([len(h) for h in hashes], dtype=np.int64)
        flat = [pair for h in hashes for pair in h]
        # columns 2i and 2i + 1 are the hashes of level i
        table = np.stack(flat) if flat else np.empty((0, 2 * len(levels)), dtype=np.int64)
        depth = np.full(len(flat), len(levels))
        open_ = np.ones(len(flat), dtype=bool)
        for i, level in enumerate(levels):
            rejected = open_ & ~level.holds(np.ascontiguousarray(table[:, 2 * i]), np.ascontiguousarray(table[:, 2 * i + 1]))
            depth[rejected] = i
            open_ &= ~rejected
        verdicts = depth % 2 == 1
        return pd.Series([v.tolist() for v in np.split(verdicts, np.cumsum(sizes)[:-1])] if len(sizes) else [], dtype=object)

    hashes = F.transform(keys, lambda k: F.array(*[h for i in range(len(levels)) for h in _hashes(k, i)]))
    marked = F.arrays_zip(keys.alias("key"), on_list(hashes).alias("on"))
    return F.transform(F.filter(marked, lambda m: m["on"]), lambda m: m["key"])


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = RULES, max_bits: int = MAX_BITS) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed_key) for every row of `pages` (page_id, url).

    The verdict is that of the longest fitting rule, else `block` if a key of the url is in `listed`
    (column key: hosts, or hosts with a whole path), else `allow`. listed_key: the longest such key, null
    if there is none. Null urls have no host, no path and no key, and are allowed.
    """
    host, path = url_parts(F.col("url"))
    read = pages.select("page_id", host.alias("host"), path.alias("path"))
    asked = read.select("host", "path").distinct().select("host", "path", F.explode(candidate_keys(F.col("host"), F.col("path"))).alias("key"))
    levels = cascade(listed, asked.select("key"), max_bits)
    if levels is None:
        on_list = asked.join(listed.distinct(), "key").groupBy("host", "path").agg(F.collect_list("key").alias("_listed"))
        found = read.join(on_list, ["host", "path"], "left").withColumn("_listed", F.coalesce("_listed", F.array()))
    else:
        found = read.withColumn("_listed", listed_keys(candidate_keys(F.col("host"), F.col("path")), levels))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    longest = F.array_max(F.transform("_listed", lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))["key"]
    return found.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.size("_listed") > 0, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), longest.alias("listed_key"))
