"""Receipt log -> public index, pages, documents and manifest; and the rerun slice."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signpost import values as V
from signpost.operators import publish, rerun
from signpost.session import child_names, cut, file_system, stored
from signpost.sources import evidence as EV
from signpost.sources.domain_list import read_domain_list
from signpost.sources.receipts import read_receipts
from signpost.sources.sinks import compact_json, write_documents, write_rerun_list


def canonical_index(receipts: DataFrame, positives: DataFrame, evidence: DataFrame) -> DataFrame:
    """Canonical rows with storage keys and previews.

    The choice runs on the narrow typed columns; variants and probes join back for the winners only.
    """
    wide = ["aggregates", "probes", "tags"]
    values = publish.index_values(receipts)
    chosen = publish.canonical(publish.mark_eligible(values.drop(*wide), positives))
    return publish.storage_keys(chosen.join(EV.evidence_columns(evidence), "domain", "left"))


def export_public(spark: SparkSession, receipts_path: str, positives: DataFrame, evidence: DataFrame, output: str, page_size: int = V.PAGE_SIZE) -> None:
    """Write pages, sitemaps, details, proofs, evidence copies, manifest and pointer below `output`."""
    receipts = read_receipts(spark, receipts_path)
    rows = cut(canonical_index(receipts, positives, evidence))
    public = publish.with_list_position(rows.where("detail_eligible"))
    listed = publish.page_document(publish.list_pages(publish.list_entries(public), page_size), "pages", f"{V.PUBLIC_PREFIX}/pages", "results")
    maps = publish.page_document(publish.sitemap_pages(public), "sitemaps", V.SITEMAP_PREFIX, "domains")
    winners = receipts.select("pos", "aggregates", "probes").join(public.drop("list_position"), "pos")
    details = stored(publish.site_detail(winners), "details")  # read for the documents and for the proofs
    detail_docs = details.select(F.lit("receipts").alias("kind"), F.col("receipt_r2_key").alias("key"), compact_json(F.col("detail")).alias("payload"))
    proof_docs = publish.proofs(details).select(F.lit("proofs").alias("kind"), "key", "payload")
    raw = receipts.where(F.trim("domain") != "")
    manifest = publish.manifest(
        publish.export_totals(raw, rows), publish.label_counts(public), F.lit(datetime.now(timezone.utc).isoformat()), page_size
    )
    as_document = lambda kind, key, df: df.select(F.lit(kind).alias("kind"), F.lit(key).alias("key"), compact_json(F.struct(*df.columns)).alias("payload"))
    manifest_docs = as_document("manifests", f"{V.PUBLIC_PREFIX}/manifest.json", manifest)
    latest_docs = as_document("manifests", "manifests/v1/latest.json", publish.latest_pointer(manifest))
    documents = listed.unionByName(maps).unionByName(detail_docs).unionByName(proof_docs).unionByName(manifest_docs).unionByName(latest_docs)
    write_documents(documents, f"{output}/documents")
    publish.evidence_copies(public, evidence).write.mode("overwrite").parquet(f"{output}/evidence")
    publish.site_index(rows).write.mode("overwrite").parquet(f"{output}/index")


KEPT_KINDS = ["sitemaps"]  # fixed value: what an export that is not clean leaves in place


def current_version(spark: SparkSession, output: str) -> str | None:
    """The folder of the version readers should take, the one switched to last."""
    names = child_names(spark, f"{output}/pointers")
    return f"{output}/versions/{names[-1]}" if names else None


def publish_version(
    spark: SparkSession, receipts_path: str, positives: DataFrame, evidence: DataFrame, output: str, page_size: int = V.PAGE_SIZE, clean: bool = False, keep: int = 2,
) -> str:
    """Export into a folder of its own and switch to it last, so readers never see half an export.

    The switch is one small file whose name is the version. An export that breaks leaves none and its folder is
    written again by the next. Unless `clean`, documents of KEPT_KINDS that the new version does not
    replace stay. The last `keep` versions are left for readers that still use them.
    """
    before = current_version(spark, output)
    name = f"{int(before.rsplit('/', 1)[1]) + 1 if before else 1:06d}"
    folder = f"{output}/versions/{name}"
    export_public(spark, receipts_path, positives, evidence, folder, page_size)
    if before and not clean:
        documents = lambda version: spark.read.schema("key string, payload string, kind string").json(f"{version}/documents").where(F.col("kind").isin(*KEPT_KINDS))
        stay = documents(before).join(documents(folder).select("key"), "key", "left_anti")
        stored(stay, "stay").write.mode("append").partitionBy("kind").json(f"{folder}/documents")
    system, pointer = file_system(spark, f"{output}/pointers/{name}")
    system.create(pointer).close()
    for old in child_names(spark, f"{output}/versions"):
        if int(old) <= int(name) - keep:
            system.delete(file_system(spark, f"{output}/versions/{old}")[1], True)
    return folder


def build_rerun_slice(spark: SparkSession, receipts_path: str, list_path: str, output: str, limit: int | None = None, **rules) -> DataFrame:
    """Write the rerun list and return the counts per selection rule."""
    hints = rerun.log_hints(read_receipts(spark, receipts_path, strict=False))
    selected = cut(rerun.selected_domains(hints, **rules))
    write_rerun_list(rerun.rerun_slice(read_domain_list(spark, list_path), selected, limit), output)
    return rerun.rerun_counts(selected)
