import datetime as dt
import random

import pytest

from spendlake.llm import warc_revisit as R
from pyspark.sql import functions as F

SCHEMA = "record_id long, url string, date timestamp, kind string, headers map<string,string>, payload_sha256 string, payload_bytes long, latest string"


def brute(records, canonical):
    out = []
    for i, url, date, kind, headers, *_ in records:
        if kind != "revisit":
            continue
        before = [r for r in records if r[3] == "response" and canonical[r[1]] is not None and canonical[r[1]] == canonical[url] and r[0] is not None and r[2] is not None and date is not None and i is not None and r[2] < date]
        best = max(before, key=lambda r: (r[2], r[0]), default=None)
        mine = {k.lower(): v for k, v in (headers or {}).items()}
        theirs = {k.lower(): v for k, v in (best[4] or {}).items()} if best else {}
        status = "no_response"
        if best:
            tags = [h["etag"].removeprefix("W/") if h.get("etag") else None for h in (mine, theirs)]
            times = [h.get("last-modified") for h in (mine, theirs)]
            pair = tags if all(tags) else times if all(times) else None
            status = "no_validator" if pair is None else "resolved" if pair[0] == pair[1] else "changed"
        merged = None
        if status == "resolved":
            merged = theirs | {k: v for k, v in mine.items() if k in R.PERMITTED and v is not None}
            merged = "\n".join(sorted(f"{k}: {v or ''}" for k, v in merged.items()))
        out.append((i, status, best and best[0], best[5] if status == "resolved" else None, merged))
    return sorted(out, key=repr)


@pytest.mark.parametrize("per_bucket", [1_000_000, 7])
def test_matches_brute_force(spark, per_bucket):
    rng = random.Random(per_bucket)
    urls = ["http://a.com/x", "https://www.A.com/x/", "http://a.com:80/x#f", "http://a.com/x?utm_source=q", "http://a.com/x?b=2&a=1", "http://u@a.com/x?a=1&b=2", None, "nothing"]
    urls += ["http://hot.com/"] * 8
    records = []
    for i in range(300):
        kind = rng.choice(["response", "revisit"])
        headers = {k: v for k, v in (("ETag", rng.choice(['"1"', 'W/"1"', '"2"'])), ("last-modified", rng.choice(["m", "n"])), ("Content-Type", "t%d" % i), ("Cache-Control", "c%d" % i), ("Content-Length", "9"))
                   if rng.random() < 0.7}
        date = None if rng.random() < 0.03 else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randint(0, 60))
        records.append((None if rng.random() < 0.02 else i, rng.choice(urls), date, kind, None if rng.random() < 0.05 else headers, f"s{i}", i, "clash"))
    records += records[:10]
    df = spark.createDataFrame(records, SCHEMA)
    canonical = {r["url"]: r["c"] for r in df.select("url", R.canonical_url(F.col("url")).alias("c")).collect()}
    got = sorted(((r["record_id"], r["status"], r["response_id"], r["payload_sha256"], r["headers"]) for r in R.resolve_revisits(df, per_bucket).collect()), key=repr)
    assert got == brute(records, canonical)


def test_canonical_urls(spark):
    same = ["http://a.com/x", "https://www.A.com/x/", "http://a.com:80/x#f", "https://u:p@a.com/x?utm_source=q&ref=1"]
    df = spark.createDataFrame([(u,) for u in [*same, "http://a.com/x?b=2&a=1", None, "x"]], "u string").select(R.canonical_url(F.col("u")).alias("c"))
    assert [r["c"] for r in df.collect()] == ["a.com/x"] * 4 + ["a.com/x?a=1&b=2", None, None]


def test_empty_table(spark):
    assert R.resolve_revisits(spark.createDataFrame([], SCHEMA)).collect() == []


def test_five_thousand_buckets_and_null_dates(spark):
    """The plan does not grow with the buckets, and the answer is that of one bucket."""
    events = spark.range(10_000).selectExpr("id % 7 AS k", "id AS i", "CASE WHEN id % 11 > 0 THEN timestamp_seconds((id * 7919) % 9973) END AS t", "CASE WHEN id % 3 = 0 THEN id END AS v")
    plan = lambda n: len(R.latest_before(events, "k", ["t", "i"], "v", "t", n)._jdf.queryExecution().optimizedPlan().toString())
    got = sorted(map(tuple, R.latest_before(events, "k", ["t", "i"], "v", "t", 2).select("k", "i", "latest").collect()))
    assert got == sorted(map(tuple, R.latest_before(events, "k", ["t", "i"], "v", "t", 10_000).select("k", "i", "latest").collect()))
    assert plan(2) <= 1.2 * plan(1_000)
