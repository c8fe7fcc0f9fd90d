from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driver_queries import streams
from signpost.session import child_names, scratch_path
from signpost.streaming import jobs, state

START = datetime(2024, 1, 1)


def verdict(domain, minutes, group="text", status=None, sha="s", size=13):
    return (domain, 1, "robots_txt", "robots", group, "u", 200, "text/plain", "u", size, sha, START + timedelta(minutes=minutes), "r", status, "valid", "d")


def control(domain, minutes, sha="s", size=13):
    return (domain, 1, "text", (200, "text/plain", size, sha), START + timedelta(minutes=minutes))


def test_controls_before_and_after_their_pages(spark):
    path = scratch_path(spark, "logs")
    pages = [
        verdict("same", 10), verdict("later", 10), verdict("other", 10), verdict("none", 10), verdict("far", 10), verdict("decided", 10, status="missing"),
        verdict("ungrouped", 10, group=None), verdict("twice", 10), verdict("end", 5000)]
    controls = [control("same", 9), control("other", 11, sha="x"), control("far", 200), control("twice", 8), control("twice", 9, sha="x"), control("decided", 9), control("ungrouped", 9), control("end", 5000)]
    batches = [(pages[:-1], controls), ([], [control("later", 30)]), (pages[-1:], controls[-1:])]
    for i, (found, named) in enumerate(batches):
        rows = spark.createDataFrame(found, jobs.VERDICT_LOG.rsplit(",", 1)[0]).withColumn("facts", F.parse_json(F.lit('{"a":1}')))
        jobs._appear(f"{path}/verdicts", i, lambda rows=rows: rows)
        jobs._appear(f"{path}/controls", i, lambda named=named: spark.createDataFrame(named, jobs.CONTROL_LOG))
    # a repeated batch changes nothing
    jobs._appear(f"{path}/verdicts", 0, lambda: spark.createDataFrame([], "x int"))
    assert child_names(spark, f"{path}/verdicts") == ["000000000000", "000000000001", "000000000002"]
    out = scratch_path(spark, "out")
    jobs.run_available(jobs.matched_outcomes(spark, path, "1 hour", files=1), out, scratch_path(spark, "progress"))
    got = {r.domain: (r.status, r.facts is None) for r in spark.read.parquet(out).collect()}
    assert got.pop("end", None) in (None, ("fallback", True))
    assert got == {
        "same": ("fallback", True), "later": ("fallback", True), "other": ("valid", False), "none": ("valid", False), "far": ("valid", False),
        "decided": ("missing", False), "ungrouped": ("valid", False), "twice": ("fallback", True)}


def test_positive_state_keeps_the_last_receipt(spark):
    path, progress = scratch_path(spark, "receipts"), scratch_path(spark, "progress")
    schema = "domain string, pos long, label string, is_interesting boolean"
    batches = [
        [("a", 1, "x", True), ("b", 5, "y", True), ("c", 2, "z", False)],
        [("a", 3, "gone", False), ("b", 4, "older", False), ("c", 7, "back", True), ("c", 6, "no", False)],
        [("a", 2, "too late", True), ("d", 9, "new", None)],
    ]
    want = [{("a", 1), ("b", 5)}, {("b", 5), ("c", 7)}, {("b", 5), ("c", 7)}]
    for rows, expected in zip(batches, want, strict=True):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        state.keep_positive_state(stream, progress).awaitTermination()  # every turn starts again on the checkpoint
        got = state.read_positive_state(spark, progress).collect()
        assert {(r.domain, r.pos) for r in got} == expected
    assert {r.label for r in got} == {"y", "back"}


def test_positive_state_takes_plain_rows():
    """No frame is made per domain: that cost more than the state."""
    kept = StructType.fromDDL("pos long, label string, is_interesting boolean")
    last = state.LastReceipt(kept, "is_interesting")
    stored = []
    last.last = SimpleNamespace(get=lambda: stored[-1] if stored else None, update=stored.append)
    rows = lambda *pairs: iter([Row(domain="a", pos=p, label=f"l{p}", is_interesting=i) for p, i in pairs])
    assert list(last.handleInputRows(("a",), rows((1, True), (4, True), (3, False)), None)) == [Row(domain="a", pos=4, is_positive=True)]
    assert list(last.handleInputRows(("a",), rows((2, False)), None)) == []
    assert list(last.handleInputRows(("a",), rows((6, None)), None)) == [Row(domain="a", pos=6, is_positive=False)]
    assert list(last.handleInputRows(("a",), rows((7, False)), None)) == []
    assert stored == [(4, "l4", True), (6, "l6", None), (7, "l7", False)]


def test_a_batch_of_the_crawl_is_written_by_all_cores(spark, sf, monkeypatch):
    paths = {}

    def first_batch(stream, out, progress):
        raise InterruptedError

    monkeypatch.setattr(streams, "scratch_path", lambda s, name: paths.setdefault(name, scratch_path(s, name)))
    monkeypatch.setattr(streams.jobs, "record_verdicts", first_batch)
    with pytest.raises(InterruptedError):
        streams.stream_outcomes(spark, sf)
    assert len(spark.read.parquet(f"{paths['input']}/0").inputFiles()) > 1
