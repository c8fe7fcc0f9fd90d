"""Registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from signpost.llm.conversations import damaged, digest as conversation_digest
from signpost.llm.decontaminate import contamination
from signpost.llm.html_extract import main_text
from signpost.llm.language import identify
from signpost.llm.mixing import mix
from signpost.llm.packing import pack
from signpost.llm.personal import digest, personal_data
from signpost.llm.quality_model import rate
from signpost.llm.quality_rules import judge
from signpost.llm.simhash import near_duplicates
from signpost.llm.token_files import tokenized
from signpost.llm.url_filters import judge_urls
from signpost.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))


SIZES = r"""
sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS weight
  FROM sizes GROUP BY source),
filled AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0) AS BIGINT) AS rest,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS BIGINT) AS open,
         row_number() OVER (ORDER BY source_size / weight, source IS NULL, encode(source)) AS turn
  FROM sources
  WINDOW b AS (ORDER BY source_size / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first_open AS (SELECT min(turn) AS turn FROM filled WHERE rest * weight < 3 * source_size * open),
targets AS (
  SELECT f.source, f.source_size,
         CASE WHEN o.turn IS NULL OR f.turn < o.turn THEN CAST(3 * f.source_size AS DOUBLE)
              ELSE CAST((SELECT rest FROM filled WHERE turn = o.turn) * f.weight AS DOUBLE) / (SELECT open FROM filled WHERE turn = o.turn)
         END AS target
  FROM filled f, first_open o)
"""

ORACLES["op10_mixing"] = f"""
WITH {SIZES},
ranked AS (
  SELECT doc_id, s.source, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
         CAST('0x' || substr(md5('mix' || coalesce('=' || s.source, '-')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS draw,
         row_number() OVER (PARTITION BY s.source ORDER BY substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16), doc_id NULLS FIRST, size) AS k
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
tries AS (SELECT i, r.*, draw / 64 + i / 64.0::DOUBLE AS u FROM ranked r, range(64) AS x(i)),
copied AS (SELECT *, CAST(floor(k * rate + u) - floor((k - 1) * rate + u) AS BIGINT) AS copies FROM tries),
chosen AS (
  SELECT source, arg_min(i, (miss, u)) AS i
  FROM (SELECT source, i, u, abs(sum(copies * size) - target) AS miss FROM copied GROUP BY source, i, u, target) GROUP BY source)
SELECT doc_id, c.source, size, source_size, target, copies, copies * size AS taken
FROM copied c JOIN chosen h ON c.i = h.i AND c.source IS NOT DISTINCT FROM h.source
"""


@query("op10_mixing")
def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix(table(spark, sf, "documents"))


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return judge(table(spark, sf, "documents"))


ORACLES["op9_decontamination"] = r"""
WITH
read AS (
  SELECT doc_id, hash(text) AS h, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
docs AS (SELECT *, coalesce(len(w), 0) AS n FROM read),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, w[i : i + 9] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(win) AS l FROM windows),
spots AS (SELECT doc_id, h, l, i, w[i : i + l - 1] AS win FROM (SELECT doc_id, h, w, l, unnest(range(1, n - l + 2)) AS i FROM docs, lengths WHERE n >= l)),
found AS (SELECT DISTINCT doc_id, h, i, l, item_id FROM spots JOIN windows USING (win)),
hit AS (SELECT doc_id, h, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, h, unnest(range(i, i + l)) AS p FROM found) GROUP BY ALL),
named AS (
  SELECT doc_id, h, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM (SELECT DISTINCT doc_id, h, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY ALL)
SELECT d.doc_id, d.n AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d
LEFT JOIN hit x ON d.doc_id IS NOT DISTINCT FROM x.doc_id AND d.h IS NOT DISTINCT FROM x.h
LEFT JOIN named y ON d.doc_id IS NOT DISTINCT FROM y.doc_id AND d.h IS NOT DISTINCT FROM y.h
"""


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op3_personal_data")
def op3_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return digest(personal_data(table(spark, sf, "documents")))


# fixed values: registered names of unwanted sites
UNWANTED = [f"{name}.example.{top}" for name in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org")]

ORACLES["op1_url_filters"] = r"""
WITH
rest AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(verdict, name, start) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
listed(key) AS (
  SELECT n || '.example.' || t FROM (VALUES ('adult-x'), ('ads-track'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')) a(n),
                                    (VALUES ('com'), ('net'), ('org')) b(t)),
ruled AS (
  SELECT host, path, arg_max(name || start, length(name || start)) AS rule, arg_max(verdict, length(name || start)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY host, path),
hosts AS (SELECT host, arg_max(key, length(key)) AS key FROM (SELECT DISTINCT host FROM parts) JOIN listed ON host = key OR ends_with(host, '.' || key) GROUP BY host)
SELECT page_id, p.host, p.path, r.rule, coalesce(r.verdict, CASE WHEN h.key IS NULL THEN 'allow' ELSE 'block' END) AS verdict, h.key AS listed_key
FROM parts p LEFT JOIN ruled r ON p.host = r.host AND p.path = r.path LEFT JOIN hosts h ON p.host = h.host
"""


@query("op1_url_filters")
def op1_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    listed = spark.createDataFrame([(k,) for k in UNWANTED], "key string")
    return judge_urls(table(spark, sf, "pages"), listed)


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return tokenized(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), special=True)


@query("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return main_text(table(spark, sf, "pages"))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return identify(table(spark, sf, "documents"))


@query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return rate(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op11_best_fit_packing")
def op11_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(table(spark, sf, "embeddings"))


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_digest(damaged(table(spark, sf, "conversations")))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)
