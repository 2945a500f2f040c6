"""Resolution of not-modified revisits in web archives.

A revisit record (HTTP 304) has no body. It is joined as of its date, by canonical URL, to the
latest full response that is strictly earlier; if the validators agree (entity tag by weak
comparison, else last-modified), the record is the stored response with the headers that a 304
may change taken from the revisit.

The join is a window in two levels: dates are cut into buckets of about ``rows_per_bucket`` rows,
the last response of every (URL, bucket) is an aggregation combined before the shuffle, it is
carried to later buckets over one row a bucket, and rows are then ordered only within their
(URL, bucket). A URL that has a third of all captures is so spread over as many tasks as needed.

Defined cases: records with a null URL, date or id are unresolved (``no_response``); of responses
with the same date the greatest record id counts; a response at the very date of the revisit is
not earlier; without a common validator the revisit stays unresolved (``no_validator``), with a
differing one too (``changed``); repeated revisit rows give repeated results.
"""
from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.frames import lower_ascii

#: Headers that a 304 response may replace in the stored one.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"^(utm_[a-z]+|ref|gclid|fbclid)="
ROWS_PER_BUCKET = 1_000_000


def canonical_url(url: Column) -> Column:
    """Without scheme, default port, user part, fragment, tracking parameters, ``www.`` and closing
    slash; host in lower case; remaining parameters sorted. Null if there is no ``://``."""
    host = lower_ascii(F.regexp_extract(url, r"://(?:[^/?#@]*@)?([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), "&")
    query = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(url.contains("://"), F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))))


def merged_headers(stored: Column, newer: Column) -> Column:
    """Headers (names in lower case) of the stored response, with permitted ones from the revisit."""
    newer = F.map_filter(newer, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(newer, k)), newer)


def headers_text(headers: Column) -> Column:
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit(""))))), "\n")


def latest_before(events: DataFrame, key: str, order: list[str], value: str, date: str,
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``events`` with ``latest``: the last non-null ``value`` of the key before each row, by ``order``."""
    n = events.count()
    buckets = max(1, -(-n // rows_per_bucket))
    events = events.withColumn("_t", F.coalesce(F.unix_micros(date).cast("double"), F.lit(float("-inf"))))
    cuts = events.approxQuantile("_t", [i / buckets for i in range(1, buckets)], 0.1 / buckets) if buckets > 1 else []
    # the bucket is found by binary search: neither the plan nor a row's work grows with the number of buckets
    splits = [float("-inf"), *sorted({c for c in cuts if c > float("-inf")}), float("inf")]
    events = Bucketizer(splits=splits, inputCol="_t", outputCol="_at").transform(events) if len(splits) > 2 else events.withColumn("_at", F.lit(0))
    events = events.withColumn("_bucket", F.col("_at").cast("int")).drop("_t", "_at")
    last = events.filter(F.col(value).isNotNull()).groupBy(key, "_bucket").agg(F.max_by(value, F.struct(*order)).alias("_last"))
    grid = events.groupBy(key, "_bucket").agg(F.lit(1).alias("_one")).join(last, [key, "_bucket"], "left")
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.select(key, "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    inside = Window.partitionBy(key, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = events.join(carried, [key, "_bucket"])
    return out.withColumn("latest", F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("_carried"))).drop("_bucket", "_carried")


def resolve_revisits(records: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Every revisit of ``records`` (record_id, url, date, kind 'response' or 'revisit', headers,
    payload_sha256, payload_bytes) with the response that it stands for."""
    names = ["record_id", "url", "date", "kind", "headers", "payload_sha256", "payload_bytes"]
    lower = F.map_from_entries(F.transform(F.map_entries("headers"), lambda e: F.struct(F.lower(e["key"]), e["value"])))
    records = records.select(*names).withColumn("headers", F.coalesce(lower, F.create_map().cast("map<string,string>")))
    records = records.withColumn("canonical", canonical_url(F.col("url")))
    usable = F.col("canonical").isNotNull() & F.col("date").isNotNull() & F.col("record_id").isNotNull()
    full = F.struct("record_id", "date", "headers", "payload_sha256", "payload_bytes")
    # at one date revisits come first: a response of that date is not earlier
    events = records.filter(usable).withColumn("_full", F.col("kind") == "response")
    events = events.withColumn("_response", F.when(F.col("_full"), full))
    joined = latest_before(events, "canonical", ["date", "_full", "record_id"], "_response", "date", rows_per_bucket)
    lost = records.filter(~usable & (F.col("kind") == "revisit"))
    found = joined.filter(F.col("kind") == "revisit").select(*names, "canonical", "latest").unionByName(
        lost.select(*names, "canonical", F.lit(None).cast(joined.schema["latest"].dataType).alias("latest")))
    tag = lambda h: F.regexp_replace(h["etag"], "^W/", "")
    mine, theirs = F.col("headers"), F.col("latest.headers")
    same_tag, same_date = tag(mine) == tag(theirs), mine["last-modified"] == theirs["last-modified"]
    status = (F.when(F.col("latest").isNull(), "no_response")
              .when(same_tag.isNotNull(), F.when(same_tag, "resolved").otherwise("changed"))
              .when(same_date.isNotNull(), F.when(same_date, "resolved").otherwise("changed"))
              .otherwise("no_validator"))
    found = found.withColumn("status", status)
    ok = F.col("status") == "resolved"
    return found.select("record_id", "canonical", "status", F.col("latest.record_id").alias("response_id"),
                        F.when(ok, F.col("latest.payload_sha256")).alias("payload_sha256"),
                        F.when(ok, F.col("latest.payload_bytes")).alias("payload_bytes"),
                        F.when(ok, headers_text(merged_headers(theirs, mine))).alias("headers"))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records derived from all pages: each page is a full response at a minute given by its
    id, and is asked for again a day later with the validators of its own body (by entity tag for
    even ids, by last-modified for odd ones)."""
    seconds = F.col("page_id") * 60 + 1_700_000_000
    body = F.coalesce("html", F.lit(""))
    tag = F.concat(F.lit('"'), F.substring(F.md5(body), 1, 16), F.lit('"'))
    modified = F.concat(F.lit("rev-"), F.substring(F.md5(body), 17, 8))
    first = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", F.timestamp_seconds(seconds).alias("date"), F.lit("response").alias("kind"),
        F.create_map(F.lit("ETag"), tag, F.lit("Last-Modified"), modified, F.lit("Content-Type"), F.lit("text/html"),
                     F.lit("Cache-Control"), F.lit("max-age=60")).alias("headers"),
        F.sha2(body, 256).alias("payload_sha256"), F.octet_length(body).cast("long").alias("payload_bytes"))
    even = F.col("page_id") % 2 == 0
    again = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", F.timestamp_seconds(seconds + 86_400).alias("date"), F.lit("revisit").alias("kind"),
        F.create_map(F.when(even, F.lit("ETag")).otherwise(F.lit("Last-Modified")), F.when(even, F.concat(F.lit("W/"), tag)).otherwise(modified),
                     F.lit("Cache-Control"), F.lit("max-age=600"), F.lit("Content-Type"), F.lit("text/plain")).alias("headers"),
        F.lit(None).cast("string").alias("payload_sha256"), F.lit(None).cast("long").alias("payload_bytes"))
    return first.unionByName(again)
