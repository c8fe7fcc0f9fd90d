import json

import pytest
from pyspark.sql import functions as F

from driver_queries.receipts import evidence, positives_of, receipt_lines
from signpost.plans.export import build_rerun_slice, current_version, export_public, publish_version
from signpost.session import child_names, scratch_path


def test_export_and_rerun(spark, sf):
    log, out = scratch_path(spark, "receipts"), scratch_path(spark, "public")
    receipt_lines(spark, sf).repartitionByRange(3, "pos").sortWithinPartitions("pos").select("line").write.text(log)
    export_public(spark, log, positives_of(spark, sf), evidence(spark, sf), out, page_size=30)
    docs = spark.read.json(f"{out}/documents").collect()
    kinds = {}
    for d in docs:
        kinds.setdefault(d.kind, {})[d.key] = json.loads(d.payload)
    manifest = kinds["manifests"]["top-sites/v1/manifest.json"]
    public = manifest["public_receipt_rows"]
    assert 0 < public <= manifest["total_rows"] < manifest["raw_receipt_count"] == 1000
    pages = [kinds["pages"][k] for k in sorted(kinds["pages"])]
    listed = [r for p in pages for r in p["results"]]
    assert [r["list_position"] for r in listed] == list(range(1, public + 1))
    assert listed == sorted(listed, key=lambda r: (-r["score_overall"], r["domain"]))
    assert pages[0]["pagination"] == {"page": 1, "pageSize": 30, "total": public, "totalPages": len(pages)}
    assert [d for k in sorted(kinds["sitemaps"]) for d in kinds["sitemaps"][k]["domains"]] == [r["domain"] for r in listed]
    assert len(kinds["receipts"]) == len(kinds["proofs"]) == public
    one = next(iter(kinds["receipts"].values()))
    assert one["source"] == "top_site_receipt" and "rank" in one and one["evidence"]["receipt_r2_key"].startswith("receipts/v1/")
    assert sum(manifest["label_counts"].values()) == public
    index = spark.read.parquet(f"{out}/index")
    assert index.count() == manifest["total_rows"] and len(index.columns) == 50
    assert spark.read.parquet(f"{out}/evidence").count() == index.select(
        F.sum(sum(F.col(c).isNotNull().cast("int") for c in ("robots_r2_key", "llms_r2_key", "llms_full_r2_key")))).first()[0]

    names = [r.domain for r in index.orderBy("domain").limit(40).collect()]
    csv, rerun = scratch_path(spark, "list"), scratch_path(spark, "rerun")
    spark.createDataFrame([(f"{i + 1},{n}" if i % 2 else n,) for i, n in enumerate(names + names)], "value string").coalesce(1).write.text(csv)
    counts = {r.branch: r.domains for r in build_rerun_slice(spark, log, csv, rerun).collect()}
    lines = [r.value for r in spark.read.text(rerun).collect()]
    assert set(counts) == {"label", "hints"} and 0 < len(lines) <= 40
    assert all(line.startswith(",") == (names.index(line.split(",")[1]) % 2 == 0) for line in lines)


def test_versions_are_switched_last(spark, sf):
    log, out = scratch_path(spark, "receipts"), scratch_path(spark, "public")
    receipt_lines(spark, sf).repartitionByRange(3, "pos").sortWithinPartitions("pos").select("line").write.text(log)
    positives, found = positives_of(spark, sf), evidence(spark, sf)
    assert current_version(spark, out) is None
    keys = lambda version, kind: {r.key for r in spark.read.json(f"{version}/documents").where(F.col("kind") == kind).collect()}
    first = publish_version(spark, log, positives, found, out, page_size=10)
    assert current_version(spark, out) == first
    maps, details = keys(first, "sitemaps"), keys(first, "receipts")
    none = positives.limit(0)
    second = publish_version(spark, log, none, found, out, page_size=10)
    # without positives nothing is public: pages and details go, the sitemaps of before stay
    assert current_version(spark, out) == second != first
    assert maps and maps <= keys(second, "sitemaps") and details and not keys(second, "receipts")
    third = publish_version(spark, log, none, found, out, page_size=10, clean=True)
    assert not maps & keys(third, "sitemaps")
    assert child_names(spark, f"{out}/versions") == ["000002", "000003"]
    # an export that breaks before the switch changes nothing for readers
    with pytest.raises(Exception):
        publish_version(spark, log + "-missing", none, found, out)
    assert current_version(spark, out) == third
