"""The ranked domain list: tolerant line parsing and domain normalisation."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from signpost.functions.stage import compute, spread
from signpost.functions.text import SPACE, strip
from signpost.functions.urls import part
from signpost.session import prepare
from signpost.sources.position import number_sorted, numbered_lines, offsets, read_lines

# fixed values: header words that are no domain
HEADER_WORDS = ["domain", "root_domain", "host"]
NON_ASCII = r"[^\x00-\x7f]"


@pandas_udf(StringType())
def _idna(names: pd.Series) -> pd.Series:
    def encode(name: str | None) -> str | None:
        if name is None:
            return None
        try:
            return name.encode("idna").decode("ascii")
        except UnicodeError:
            return None

    return names.map(encode)


def _columns(line: Column) -> Column:
    """The first two CSV columns; a lone column gives an array of one."""
    plain = F.split(line, ",", 3)
    quoted = F.from_csv(line, F.lit("a string, b string"))
    two = F.array(F.coalesce(quoted["a"], F.lit("")), F.coalesce(quoted["b"], F.lit("")))
    return F.when(line.contains('"'), F.when(quoted["b"].isNull(), F.slice(two, 1, 1)).otherwise(two)).otherwise(plain)


def _trim_dots(c: Column) -> Column:
    return F.regexp_replace(c, r"^\.+|\.+\z", "")


def with_ascii_domain(df: DataFrame, candidate: str) -> DataFrame:
    """`name`: everything of the normalisation except the IDNA step; null for header words and blanks."""
    lowered = compute(df, lowered=_trim_dots(F.lower(strip(F.col(candidate)))))
    name = F.col("lowered")
    location = part(name, 2)
    host = F.when(name.contains("://"), F.when(location != "", location).otherwise(part(name, 3))).otherwise(
        F.split_part(name, F.lit("/"), F.lit(1))
    )
    bare = F.split_part(F.substring_index(host, "@", -1), F.lit(":"), F.lit(1))
    cleaned = compute(lowered, cleaned=_trim_dots(strip(bare)))
    usable = ~name.isin(*HEADER_WORDS) & (F.col("cleaned") != "")
    return cleaned.withColumn("name", F.when(usable, F.col("cleaned"))).drop("lowered", "cleaned")


def parse_domains(lines: DataFrame) -> DataFrame:
    """(row_index, line) -> (row_index, rank, domain); unusable lines drop but keep their index."""
    cells = compute(lines.select("row_index", "line"), cells=_columns(F.col("line")))
    first = compute(cells, ["row_index", "cells"], first=strip(F.col("cells")[0]))
    parts = compute(
        first,
        tabs=F.filter(F.transform(F.split("first", "\t"), strip), lambda x: x != ""),
        words=F.split("first", rf"(?U){SPACE}+", 2),
    )
    first, tabs, words = F.col("first"), F.col("tabs"), F.col("words")
    digits = r"^[0-9]+$"

    def ranked(rank: Column, name: Column) -> Column:
        return F.struct(rank.alias("rank"), name.alias("candidate"))

    entry = (
        F.when((F.size("cells") > 1) & first.rlike(digits), ranked(first, F.col("cells")[1]))
        .when(first.contains("\t") & (F.size(tabs) >= 2) & F.get(tabs, 0).rlike(digits), ranked(F.get(tabs, 0), F.get(tabs, 1)))
        .when((F.size(words) == 2) & F.get(words, 0).rlike(digits), ranked(F.get(words, 0), F.get(words, 1)))
        .otherwise(ranked(F.lit(None).cast("string"), first))
    )
    named = with_ascii_domain(spread(parts, ["row_index"], entry), "candidate").where("name IS NOT NULL")
    foreign = F.col("name").rlike(NON_ASCII)
    valid_ascii = ~F.col("name").rlike(r"\.\.") & ~F.col("name").rlike(r"[^.]{64,}")
    domain = F.when(foreign, _idna(F.when(foreign, F.col("name")))).when(valid_ascii, F.col("name"))
    ranked_rows = named.select("row_index", F.col("rank").try_cast("int").alias("rank"), domain.alias("domain"))
    return ranked_rows.where("domain IS NOT NULL")


# A cell is quoted when it starts with a quote; two quotes inside stand for one. What follows the closing
# quote up to the comma belongs to the cell.
_CLOSED = r'(?:"(?:[^"]|"")*+"(?!")[^,]*+,|(?!")[^,]*+,)*+'
_OPEN = r'"(?:[^"]|"")*+'
ENDS_OPEN_FROM_OUTSIDE = rf"^{_CLOSED}{_OPEN}\z"
ENDS_OPEN_FROM_INSIDE = rf'^(?:[^"]|"")*+(?:\z|"(?!")[^,]*+,{_CLOSED}{_OPEN}\z)'
FIELD_LIMIT = 131_072  # fixed value: characters of a record that are read


def records(lines: DataFrame) -> DataFrame:
    """(row_index, line): lines (line, file, block, seq) put together where a quoted cell goes over line breaks.

    Whether a line ends inside a quoted cell hangs on whether it starts in one, so a line is a function of
    one bit: it keeps it, flips it, or sets it. Functions of the lines of a split combine, one row a split goes
    through the prefix over a file, and every line then knows where it starts. Rows of a split stay
    together in one task, no more. Of a record that a missing quote makes endless the first FIELD_LIMIT
    characters are kept.
    """
    outside, inside = F.col("line").rlike(ENDS_OPEN_FROM_OUTSIDE), F.col("line").rlike(ENDS_OPEN_FROM_INSIDE)
    quoted = F.col("line").contains('"')
    told = lines.withColumns({"_out": quoted & outside, "_in": ~quoted | inside})
    split = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    flips = F.sum(F.when(F.col("_out") & ~F.col("_in"), 1).otherwise(0)).over(split)
    # the last line that sets the bit, with the flips up to it
    sets = F.when(F.col("_out") == F.col("_in"), F.struct(F.col("_out").alias("bit"), F.col("_flips").alias("flips")))
    seen = told.withColumn("_flips", flips).withColumn("_set", F.last(sets, ignorenulls=True).over(split))
    odd = (F.col("_flips") - F.coalesce(F.col("_set.flips"), F.lit(0))) % 2 == 1
    # the bit after the line: set in this split, or what the split started with; flipped an odd number of times since
    after = seen.select("file", "block", "seq", "line", F.col("_set.bit").alias("bit"), odd.alias("odd"))
    ends = after.groupBy("file", "block").agg(F.max_by(F.struct("bit", "odd"), "seq").alias("e")).select("file", "block", "e.*")
    starts = _split_starts(ends)
    whole = Window.partitionBy("file", "block").orderBy("seq")
    known = after.join(starts, ["file", "block"]).withColumn("_open", F.coalesce("bit", "start") != F.col("odd"))
    begun = known.withColumn("_begins", ~F.coalesce(F.lag("_open").over(whole), F.col("start")))
    placed = begun.withColumn("_place", F.sum(F.col("_begins").cast("long")).over(split))
    sizes = placed.groupBy("file", "block").agg(F.sum(F.col("_begins").cast("long")).alias("split_rows"))
    numbered = placed.join(offsets(sizes, ["file", "block"]), ["file", "block"]).withColumn("row_index", F.col("rows_before") + F.col("_place") - 1)
    alone = F.col("_begins") & ~F.col("_open")
    parts = numbered.where(~alone).withColumn("_at", F.struct("file", "block", "seq"))
    before = F.coalesce(F.sum(F.char_length("line") + 1).over(Window.partitionBy("row_index", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    short = parts.withColumn("_before", before).where(F.col("_before") < FIELD_LIMIT)
    joined = short.groupBy("row_index").agg(F.array_sort(F.collect_list(F.struct("_at", "line"))).alias("ls"))
    text = F.substring(F.array_join(F.transform("ls", lambda x: x["line"]), "\n"), 1, FIELD_LIMIT)
    return numbered.where(alone).select("row_index", "line").unionByName(joined.select("row_index", text.alias("line")))


def _split_starts(ends: DataFrame) -> DataFrame:
    """(file, block, start): whether a split starts inside a quoted cell; one row a split, files start outside."""
    one = F.struct("block", "bit", "odd")
    listed = ends.groupBy("file").agg(F.array_sort(F.collect_list(one)).alias("xs"))
    step = lambda acc, x: F.concat(acc, F.array(F.coalesce(x["bit"], F.element_at(acc, -1)) != x["odd"]))
    states = F.aggregate("xs", F.array(F.lit(False)), step)
    return listed.select("file", F.inline(F.arrays_zip(F.transform("xs", lambda x: x["block"]).alias("block"), states.alias("start")))).where("block IS NOT NULL")


def read_domain_list(spark: SparkSession, path: str) -> DataFrame:
    """The list as CSV records. Only where some cell holds a line break are lines put together."""
    lines = read_lines(prepare(spark), path)
    quoted = lines.where(F.col("line").contains('"'))
    broken = quoted.where(F.col("line").rlike(ENDS_OPEN_FROM_OUTSIDE))
    return parse_domains(numbered_lines(spark, path) if broken.isEmpty() else records(lines))


def from_offset(domains: DataFrame, start_row_index: int) -> DataFrame:
    return domains.where(F.col("row_index") >= start_row_index)


def limited(domains: DataFrame, limit: int) -> DataFrame:
    """The first `limit` rows in list order; a negative limit gives none."""
    placed = number_sorted(domains, [F.col("row_index").asc()], "_place")
    return placed.where(F.col("_place") <= limit).drop("_place")
