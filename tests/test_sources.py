import csv
import io
import os
import random

from pyspark.sql import functions as F
import pytest

from signpost.session import scratch_path
from signpost.sources import domain_list as DL
from signpost.sources import position as P
from signpost.sources import receipts as R
from signpost.sources.fetches import clean_headers, limit_bodies
from tests.helpers import fetches


def parse(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "row_index long, line string")
    return [tuple(r) for r in DL.parse_domains(df).orderBy("row_index").collect()]


def test_domain_lines(spark):
    lines = ["1,Example.COM.", "2\ta.b", "3 c.d", "https://u@h:8/x", "domain", "", "bücher.example", "a..b", "x.y/path", "7,", "5",
             "http:///only", '9,"q.example"', "y" * 64 + ".com", " Root_Domain ", "a.b:80", "8, spaced.example "]
    assert parse(spark, lines) == [
        (0, 1, "example.com"), (1, 2, "a.b"), (2, 3, "c.d"), (3, None, "h"), (6, None, "xn--bcher-kva.example"), (8, None, "x.y"),
        (10, None, "5"), (11, None, "/only"), (12, 9, "q.example"), (15, None, "a.b"), (16, 8, "spaced.example"),
    ]


def test_limit_and_offset(spark):
    df = spark.createDataFrame([(i, None, f"d{i}") for i in range(10)], "row_index long, rank int, domain string")
    assert [r.row_index for r in DL.limited(DL.from_offset(df, 4), 3).collect()] == [4, 5, 6]
    assert DL.limited(df, -1).count() == 0


def test_positions_over_many_files(spark):
    path = scratch_path(spark, "pos")
    rows = spark.range(5000).select(F.concat(F.lit("l"), F.col("id").cast("string")).alias("value"), "id")
    rows.repartitionByRange(7, "id").sortWithinPartitions("id").select("value").write.text(path)
    got = P.numbered_lines(spark, path).collect()
    assert sorted(r.row_index for r in got) == list(range(5000))
    assert all(r.line == f"l{r.row_index}" for r in got)


@pytest.mark.parametrize("parts", [1, 8])
def test_number_sorted(spark, parts):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    got = P.number_sorted(df, [F.col("k").desc(), F.col("id").asc()], "n", parts).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 1001))
    assert [(r.k, r.id) for r in got] == sorted(((i % 7, i) for i in range(1000)), key=lambda x: (-x[0], x[1]))


def test_receipt_log_round_trip(spark):
    path = scratch_path(spark, "log")
    lines = ['{"domain":"A.example","label":"ai_readable","rank":"5","aggregates":{"x":1},"probes":{"robots_txt":{"status":"valid"},"other":5}}',
             "", "not json", '{"domain":"b.example","rank":7,"tags":["t"]}', '["list"]']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = R.read_receipts(spark, path, strict=False).orderBy("pos").collect()
    assert [r.domain for r in rows if r.domain] == ["A.example", "b.example"]
    assert rows[0].probes.robots_txt.status == "valid"
    with pytest.raises(Exception):
        R.read_receipts(spark, path, strict=True).collect()
    out = scratch_path(spark, "written")
    kept = R.read_receipts(spark, path, strict=False).where("domain IS NOT NULL")
    R.write_receipts(kept, out, max_records=1)
    R.write_receipts(kept, out)
    again = R.read_receipts(spark, out).collect()
    assert sorted(r.domain for r in again) == ["A.example", "A.example", "b.example", "b.example"]


def test_unseen(spark):
    domains = spark.createDataFrame([(0, None, "a.example"), (1, None, "b.example")], "row_index long, rank int, domain string")
    log = spark.createDataFrame([(" A.Example ",), (None,)], "domain string")
    assert [r.domain for r in R.unseen(domains, log).collect()] == ["b.example"]


def test_body_limits_and_headers(spark):
    rows = fetches(spark, [
        {"probe_key": "cart_json", "body": b"x" * 16_385}, {"probe_key": "control:text", "body": b"y" * 5_000}, {"probe_key": "homepage", "body": b""},
    ]).orderBy("probe_key").collect()
    assert [(r.byte_count, r.truncated) for r in rows] == [(16_384, True), (4_096, True), (0, False)]
    assert rows[2].body_sha256 is None
    df = spark.createDataFrame([({"X-A ": " 1 ", "x-a": "2", "": "z"},)], "h map<string,string>")
    assert df.select(clean_headers(F.col("h")).alias("h")).first().h == {"x-a": "2"}
    assert limit_bodies(spark.createDataFrame([("robots_txt", None)], "probe_key string, body binary")).first().byte_count == 0


CELLS = ["a.example", "", "7", '"b.example"', '"two\nlines"', '"a ""quoted"" word"', '"comma, and\nbreak\n\nand more"', 'plain"quote', '"closed"tail', '""', '"""start\n"""', " spaced ", '"x\n"tail']


def csv_rows(path):
    with open(path, newline="", encoding="utf-8") as f:
        return list(csv.reader(f))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("split", [40, 100_000])
def test_records_with_line_breaks_equal_a_csv_reader(spark, tmp_path, seed, split):
    draw = random.Random(seed)
    want = []
    for k in range(3):
        rows = [",".join(draw.choice(CELLS) for _ in range(draw.randint(1, 4))) for _ in range(30)]
        text = "\n".join(rows) + "\n"
        if k == 2 and seed == 3:
            text += '9,"never closed\nrest of the file\n'
        (tmp_path / f"{k}.csv").write_text(text, encoding="utf-8")
        want += csv_rows(tmp_path / f"{k}.csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = sorted((r.row_index, r.line) for r in DL.records(P.read_lines(spark, str(tmp_path))).collect())
        assert [i for i, _ in got] == list(range(len(want)))
        for (_, line), cells in zip(got, want, strict=True):
            assert next(csv.reader(io.StringIO(line, newline="")), [])[:2] == [c.rstrip("\n") if "never" in c else c for c in cells[:2]]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_record_without_an_end_is_cut(spark, tmp_path):
    (tmp_path / "list.csv").write_text('1,a.example\n2,"open\n' + "line\n" * 60_000, encoding="utf-8")
    rows = {r.row_index: r.line for r in DL.records(P.read_lines(spark, str(tmp_path))).collect()}
    assert set(rows) == {0, 1} and len(rows[1]) <= DL.FIELD_LIMIT and rows[1].startswith('2,"open\nline\nline')


def test_shards_rotate_by_bytes_and_records(spark):
    rows = [(i, f"d{i}.example", "x" * (i * 37 % 300)) for i in range(400)]
    kept = spark.createDataFrame(rows, "row_index long, domain string, title string").coalesce(1)
    lines = [r.line for r in R.receipt_lines(kept).collect()]
    path = scratch_path(spark, "shards")
    R.write_receipts(kept, path, max_records=9, max_bytes=1500)
    want, size = [[]], 0
    for line in lines:
        if want[-1] and (len(want[-1]) == 9 or size + len(line) + 1 > 1500):
            want, size = [*want, []], 0
        want[-1].append(line)
        size += len(line) + 1
    local = path.removeprefix("file:")
    shards = sorted(os.listdir(local))
    files = [[os.path.join(local, s, f) for f in sorted(os.listdir(os.path.join(local, s))) if f.startswith("part-")] for s in shards if s.startswith("shard=")]
    assert all(len(f) == 1 for f in files)
    assert [open(f[0], encoding="utf-8").read().splitlines() for f in files] == want
    assert [r.row_index for r in R.read_receipts(spark, path).orderBy("pos").collect()] == list(range(400))
    R.write_receipts(kept.where("row_index < 3"), path, max_bytes=1)  # a later run comes after; a long line is a shard of its own
    again = R.read_receipts(spark, path).orderBy("pos").collect()
    assert [r.row_index for r in again] == [*range(400), 0, 1, 2] and len(os.listdir(local)) == len(shards) + 3


def test_null_members_are_written(spark):
    rows = spark.createDataFrame([("a.example", None, ({"status": "valid", "http_status": None}, None))], "domain string, rank int, probes struct<robots_txt:struct<status:string,http_status:int>,llms_txt:struct<status:string,http_status:int>>")
    assert [r.line for r in R.receipt_lines(rows).collect()] == ['{"domain":"a.example","probes":{"robots_txt":{"status":"valid","http_status":null}},"rank":null}']


def test_only_used_members_of_receipts_are_built(spark):
    line = '{"domain":"a.b","rank":1,"rank":2,"probes":{"llms_txt":{"status":"valid","http_status":"200"},"robots_txt":[1],"homepage":{}}}'
    lines = spark.createDataFrame([(0, line), (1, '{"domain":5,"probes":7}'), (2, "[]"), (3, "{} {}")], "pos long, line string")
    rows = R.parse_receipt_lines(lines, strict=False)
    found = rows.select(
        "pos", "domain", F.try_variant_get("rank", "$", "int"), "probes.llms_txt.status", "probes.llms_txt.http_status", F.col("probes.robots_txt").isNull(),
        F.col("probes.homepage").isNull(), F.col("probes").isNull())
    assert [tuple(r) for r in found.orderBy("pos").collect()] == [(0, "a.b", 2, "valid", 200, True, False, False), (1, None, None, None, None, True, True, False)]
    # what a query does not use goes: no outcome is typed for a list of domains
    assert "body_sha256 AS" not in (plan := rows.select("pos", "domain")._jdf.queryExecution().optimizedPlan().toString()) and "_packed" not in plan.split("Filter")[0], plan
