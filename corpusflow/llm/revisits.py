"""Not-modified revisit records, resolved to the responses that they stand for.

A revisit record of the server-not-modified kind has no body: the server answered
304 to a conditional request.  It is resolved by an as-of join: by canonical URL to
the latest earlier full response.  Validators are checked (a strong or weak ETag, or
else Last-Modified, must be the same), and the headers that a 304 may carry replace
the stored response's; those that describe the stored body stay.

The as-of join works on a narrow time line (URL, second, candidate): one row per URL
and second, cut into slices of time.  Inside a slice a window carries the last
response forward; between slices one row per URL and slice does.  So a URL with a
third of all records is spread over its slices and seconds, and bodies and headers
move only for the matched pairs.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import staged

#: Slices of the time line that a URL's records are spread over.
SLICES = 256
#: Headers that a 304 must not change: they describe the stored body (fixed values of RFC 9110 and 9111).
BODY_HEADERS = ["content-encoding", "content-length", "content-range", "content-type", "trailer", "transfer-encoding"]
#: Headers of one connection, kept from neither record (fixed values of RFC 9110).
HOP_HEADERS = ["connection", "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "upgrade"]

RECORD = ("record_id long, record_type string, url string, date timestamp, status int, headers map<string,string>, "
          "payload_digest string")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, no empty query, '/' for an empty path.

    A value without ``scheme://`` is only trimmed.
    """
    url = F.btrim(url)
    bare = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"\?$", "")
    scheme = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    host = F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?]*)", 1))
    port = F.when(scheme == "http", F.regexp_replace(host, r":(80)?$", "")) \
        .when(scheme == "https", F.regexp_replace(host, r":(443)?$", "")).otherwise(host)
    rest = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?]*(.*)$", 1)
    path = F.when(rest == "", "/").when(rest.startswith("?"), F.concat(F.lit("/"), rest)).otherwise(rest)
    return F.when(scheme == "", url).otherwise(F.concat(scheme, F.lit("://"), port, path))


def _lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that differ in case alone, the least spelling's value."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    first = F.aggregate(entries, F.array().cast("array<struct<key:string,value:string>>"), lambda acc, e: F.when(
        F.exists(acc, lambda x: x["key"] == F.lower(e["key"])), acc).otherwise(
        F.concat(acc, F.array(F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))))
    return F.map_from_entries(first)


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers (lower-case maps), with those that the 304 may set taken from it."""
    fixed, hop = F.array(*map(F.lit, BODY_HEADERS)), F.array(*map(F.lit, HOP_HEADERS))
    new = F.map_filter(fresh, lambda k, _: ~F.array_contains(fixed, k) & ~F.array_contains(hop, k))
    old = F.map_filter(stored, lambda k, _: ~F.map_contains_key(new, k) & ~F.array_contains(hop, k))
    return F.map_concat(old, new)


def _weak(tag: Column) -> Column:
    """An ETag without its weakness mark, for the weak comparison that a 304 is made by."""
    return F.regexp_replace(F.btrim(tag), r"^W/", "")


def latest_earlier(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """``(record_id, original_id)``: each revisit's latest strictly earlier response of the same URL, or null.

    ``records``: ``record_id, record_type, url (canonical), date``, no nulls.  Of
    responses of one second the one with the largest id counts.
    """
    # cuts at quantiles of the dates: no slice holds much more than its share of the records
    cuts = records.agg(F.percentile_approx(F.unix_micros("date"), [i / slices for i in range(1, slices)] or [0.5], 10_000)).first()[0]
    if cuts is None:
        return records.select("record_id", F.col("record_id").alias("original_id"))
    line = records.groupBy("url", "date").agg(
        F.max(F.when(F.col("record_type") == "response", F.col("record_id"))).alias("here"),
        F.max(F.col("record_type") == "revisit").alias("asks")).withColumn("micros", F.unix_micros("date").cast("double"))
    splits = [float("-inf"), *sorted({float(c) for c in cuts}), float("inf")]
    line = Bucketizer(splits=splits, inputCol="micros", outputCol="slice").transform(line).drop("micros")
    before = Window.partitionBy("url", "slice").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    inside = line.withColumn("earlier", F.last("here", ignorenulls=True).over(before))
    ends = line.filter("here is not null").groupBy("url", "slice").agg(F.max(F.struct("date", "here")).alias("end"))
    slots = line.select("url", "slice").distinct().join(ends, ["url", "slice"], "left")
    carried = slots.withColumn("carried", F.last("end.here", ignorenulls=True).over(
        Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))) \
        .filter("carried is not null").select("url", "slice", "carried")
    known = inside.filter("asks").join(carried, ["url", "slice"], "left") \
        .select("url", "date", F.coalesce("earlier", "carried").alias("original_id"))
    return records.filter("record_type = 'revisit'").join(known, ["url", "date"], "left").select("record_id", "original_id")


def resolve_revisits(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """One row per revisit: ``record_id, url, date, resolution, original_id, status, headers, payload_digest``.

    ``records`` has the columns of RECORD.  ``resolution`` is ``resolved`` (then status,
    merged headers and the body's digest are the original's), ``no_earlier_response``
    or ``validator_mismatch`` (then ``original_id`` is the response that was compared,
    and the rest is null).  Validators agree if both records have an ETag and these are
    weakly equal; if either has none, if both have the same Last-Modified.  Only a
    response with status 200 can be the original.

    Defined cases: revisits without URL or date have no earlier response; records
    without an id are left out, and of records that repeat an id one (the greatest
    values) counts; null headers are none; an empty table gives no rows; other
    columns are ignored.
    """
    names = [c.split()[0] for c in RECORD.split(", ")]
    rows = records.select(*names).filter("record_id is not null and record_type in ('response', 'revisit')") \
        .withColumn("headers", F.map_entries(_lower_keys(F.col("headers"))))
    rows = rows.groupBy("record_id").agg(F.max(F.struct(*names[1:])).alias("r")).select("record_id", "r.*") \
        .withColumn("headers", F.map_from_entries("headers")).withColumn("canonical", canonical_url(F.col("url")))
    rows = staged(rows, "revisit-records")
    timed = rows.filter("canonical is not null and date is not null and (record_type = 'revisit' or status = 200)")
    found = latest_earlier(timed.select("record_id", "record_type", F.col("canonical").alias("url"), "date"), slices)
    stored = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("original_id"), F.col("status").alias("old_status"), F.col("headers").alias("old"),
        F.col("payload_digest").alias("old_digest"))
    both = rows.filter("record_type = 'revisit'").drop("payload_digest", "status") \
        .join(found, "record_id", "left").join(stored, "original_id", "left")
    tag, old_tag = F.col("headers")["etag"], F.col("old")["etag"]
    same = F.when(tag.isNotNull() & old_tag.isNotNull(), _weak(tag) == _weak(old_tag)) \
        .otherwise(F.coalesce(F.col("headers")["last-modified"] == F.col("old")["last-modified"], F.lit(False)))
    resolution = F.when(F.col("original_id").isNull(), "no_earlier_response").when(same, "resolved").otherwise("validator_mismatch")
    ok = resolution == "resolved"
    return both.select(
        "record_id", F.col("canonical").alias("url"), "date", resolution.alias("resolution"), "original_id",
        F.when(ok, F.col("old_status")).alias("status"), F.when(ok, merged_headers(F.col("old"), F.col("headers"))).alias("headers"),
        F.when(ok, F.col("old_digest")).alias("payload_digest"))


def captures(pages: DataFrame) -> DataFrame:
    """Three crawls of the pages table as records: each page is fetched first, and asked for again twice.

    Every page gives a full response; the later crawls get a 304 (a revisit) or,
    for every fifth page, a changed response between them.  Validators come from the
    page's content; every seventh revisit has a stale ETag, every third has none.
    Pages that share a canonical URL meet in one time line.
    """
    digest = F.md5(F.coalesce("html", F.lit("")))
    changed = (F.col("crawl") == 1) & (F.col("page_id") % 5 == 0)
    kind = F.when((F.col("crawl") == 0) | changed, "response").otherwise("revisit")
    version = F.when((F.col("crawl") == 1) & changed | (F.col("crawl") == 2) & (F.col("page_id") % 5 == 0), 1).otherwise(0)
    stale = (F.col("kind") == "revisit") & (F.col("page_id") % 7 == 0)
    tagless = (F.col("kind") == "revisit") & (F.col("page_id") % 3 == 0)
    seconds = F.col("page_id") + F.col("crawl") * 86_400 * 30
    none = F.lit(None).cast("string")
    values = {
        "Date": F.date_format(F.timestamp_seconds(1_700_000_000 + seconds), "yyyy-MM-dd HH:mm:ss"),
        "ETag": F.when(tagless, none).when(stale, '"stale"').otherwise(F.concat(
            F.when(F.col("kind") == "revisit", 'W/"').otherwise('"'), F.col("digest"), F.lit("-"), F.col("version"), F.lit('"'))),
        "Last-Modified": F.concat(F.lit("v"), F.col("version")),
        "Content-Type": F.when(F.col("kind") == "response", "text/html; charset=utf-8").otherwise("text/plain"),
        "Content-Length": F.when(F.col("kind") == "response", F.col("size").cast("string")),
        "Cache-Control": F.concat(F.lit("max-age="), (F.col("crawl") * 60).cast("string")),
        "Connection": F.lit("close")}
    entries = F.array(*(F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in values.items()))
    return pages.select("page_id", "url", digest.alias("digest"), F.length("html").alias("size"),
                        F.explode(F.array(*map(F.lit, range(3)))).alias("crawl")) \
        .select("*", kind.alias("kind"), version.alias("version")).select(
            (F.col("page_id") * 3 + F.col("crawl")).alias("record_id"), F.col("kind").alias("record_type"), "url",
            F.timestamp_seconds(1_700_000_000 + seconds).alias("date"),
            F.when(F.col("kind") == "response", 200).otherwise(304).alias("status"),
            F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull())).alias("headers"),
            F.when(F.col("kind") == "response", F.concat("digest", F.lit("-"), "version")).alias("payload_digest"))
