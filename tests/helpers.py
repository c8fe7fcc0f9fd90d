from pyspark.sql import functions as F

FETCH = (
    "domain string, attempt int, probe_key string, control_group string, requested_url string, request_method string, "
    "final_url string, http_status int, content_type string, body binary, error string, headers map<string,string>, fetched_at timestamp"
)


def fetches(spark, rows):
    """Rows given as dicts over defaults, cut and digested like a read fetch log."""
    from signpost.sources.fetches import clean_headers, limit_bodies

    base = {
        "domain": "a.example", "attempt": 1, "probe_key": "homepage", "control_group": None, "requested_url": "https://a.example/",
        "request_method": "GET", "final_url": None, "http_status": 200, "content_type": "application/json", "body": b"",
        "error": None, "headers": {}, "fetched_at": None,
    }
    full = []
    for row in rows:
        r = {**base, **row}
        if isinstance(r["body"], str):
            r["body"] = r["body"].encode()
        if r["final_url"] is None and r["http_status"] is not None:
            r["final_url"] = r["requested_url"]
        full.append(tuple(r[k] for k in base))
    names = [c.split()[0] for c in FETCH.split(", ")]
    assert names == list(base)
    df = spark.createDataFrame(full, FETCH)
    return limit_bodies(df).withColumn("headers", clean_headers(F.col("headers")))


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict(recursive=True)
