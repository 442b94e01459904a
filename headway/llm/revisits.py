"""Not-modified revisit resolution for WARC records.

A revisit says that a URL was fetched again and had not changed. It is resolved
by an as-of join on the canonical URL to the latest earlier full response (by
date, then record id); the response's validators must agree with the revisit's,
and the headers that a not-modified answer may update replace the response's.

The join works in time buckets: each bucket of a URL looks back within itself,
and a bucket's first rows take the last response of the URL's earlier buckets.
So a URL with a large share of all records is split by time, and only one row
for each of its buckets meets in one place.

Outcomes: ``resolved``; ``unvalidated`` (a response, but no validator on both
sides: merged all the same); ``mismatch`` (validators differ) and ``no_response``
keep the revisit's own headers and have no payload.

Defined results: a NULL or empty URL has no response; records without a date or an id
sort first and are no one's earlier response if they have no date; full responses
are responses of status 200; header names are in lower case; repeated revisits are
resolved alike; extra columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 3600
# Header fields that a 304 answer updates; query parameters without meaning for a page.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"

RECORD = "record_id long, uri string, type string, status int, date long, headers map<string,string>, payload_digest string"


def canonical_url(url: Column) -> Column:
    """Host without www. or m. and its scheme's port, path without a closing slash, sorted query without tracking.

    http and https are one; any other scheme stays in front. A text without a
    scheme and host is itself, less its fragment.
    """
    plain = F.regexp_replace(url, "#.*$", "")
    scheme = F.lower(F.regexp_extract(plain, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(plain, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(host, r"^(www|m)\.", "")
    host = (F.when(scheme == "http", F.regexp_replace(host, ":80$", ""))
            .when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host))
    path = F.regexp_replace(F.regexp_extract(plain, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.filter(F.split(F.regexp_extract(plain, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    front = F.when(scheme.isin("http", "https"), "").otherwise(F.concat(scheme, F.lit("://")))
    whole = F.concat(front, host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(F.sort_array(query), "&")))
                     .otherwise(F.lit("")))
    return F.when(scheme == "", plain).otherwise(whole)


def validators(own: Column, full: Column) -> Column:
    """Whether the validators agree; NULL if no validator is on both sides."""
    def tag(h: Column) -> Column:
        return F.regexp_replace(h["etag"], "^W/", "")

    return F.coalesce(tag(own) == tag(full), own["last-modified"] == full["last-modified"])


def resolve(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """(record_id, date, url, outcome, response_id, headers, payload_digest) of each revisit."""
    full = (F.col("type") == "response") & (F.col("status") == 200) & F.col("uri").isNotNull() & F.col("date").isNotNull()
    rows = records.where(full | (F.col("type") == "revisit")).select(
        "record_id", "date", "headers", (F.col("type") == "revisit").alias("revisit"),
        canonical_url(F.col("uri")).alias("url"),
        F.when(full, F.struct("date", "record_id", "headers", "payload_digest")).alias("full"))
    # records without a URL never meet: each is a group of its own
    rows = rows.withColumn("group", F.coalesce(F.nullif("url", F.lit("")), F.concat(F.lit("?"), F.monotonically_increasing_id().cast("string"))))
    rows = rows.withColumn("bucket", F.coalesce(F.floor(F.col("date") / bucket_seconds), F.lit(-1)))
    last = rows.where("full is not null").groupBy("group", "bucket").agg(F.max_by("full", F.struct("date", "record_id")).alias("last"))
    seen = rows.select("group", "bucket").distinct().join(last, ["group", "bucket"], "left")
    before = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = seen.select("group", "bucket", F.last("last", True).over(before).alias("earlier"))
    within = Window.partitionBy("group", "bucket").orderBy("date", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    found = (rows.withColumn("near", F.last("full", True).over(within)).where("revisit")
             .join(earlier, ["group", "bucket"], "left")
             .withColumn("response", F.coalesce("near", "earlier")))
    own = F.coalesce("headers", F.create_map().cast("map<string,string>"))
    theirs = F.coalesce("response.headers", F.create_map().cast("map<string,string>"))
    ok = validators(own, theirs)
    outcome = (F.when(F.col("response").isNull(), "no_response").when(ok, "resolved")
               .when(~ok, "mismatch").otherwise("unvalidated"))
    updates = F.map_filter(own, lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(theirs, lambda k, v: ~F.array_contains(F.map_keys(updates), k)), updates)
    good = outcome.isin("resolved", "unvalidated")
    return found.select(
        "record_id", "date", "url", outcome.alias("outcome"), F.col("response.record_id").alias("response_id"),
        F.when(good, merged).otherwise(own).alias("headers"),
        F.when(good, F.col("response.payload_digest")).alias("payload_digest"))


def header_text(headers: Column) -> Column:
    """Sorted ``name: value`` lines."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)),
                                    lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def records_of(pages: DataFrame) -> DataFrame:
    """WARC records of crawled pages: a full response for each page and, by its id, up to three revisits.

    Revisits vary in URL form, validators and date, so that every outcome occurs.
    """
    i = F.col("page_id")
    base = pages.where(i.isNotNull()).select(
        "page_id", "url", (F.lit(1704067200) + i * 60).alias("at"), F.length("html").cast("string").alias("size"),
        F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"')).alias("tag"), F.sha2("html", 256).alias("digest"))
    at = F.col("at")
    responses = base.select(
        (i * 8).alias("record_id"), F.col("url").alias("uri"), F.lit("response").alias("type"), F.lit(200).alias("status"),
        at.alias("date"), F.create_map(
            F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.col("size"), F.lit("etag"), F.col("tag"),
            F.lit("last-modified"), (at - 86400).cast("string"), F.lit("date"), at.cast("string"),
            F.lit("server"), F.lit("httpd"), F.lit("cache-control"), F.lit("max-age=60")).alias("headers"),
        F.col("digest").alias("payload_digest"))
    k = F.col("k")
    date = at + k * k * 1000 - F.when(i % 13 == 0, 1_000_000).otherwise(0)
    etag = (F.when(i % 7 == 0, F.lit(None)).when(i % 11 == 0, F.lit('"stale"'))
            .when(k == 2, F.concat(F.lit("W/"), F.col("tag"))).otherwise(F.col("tag")))
    entries = F.array(
        F.struct(F.lit("date").alias("key"), date.cast("string").alias("value")),
        F.struct(F.lit("cache-control").alias("key"), F.concat(F.lit("max-age="), k.cast("string")).alias("value")),
        F.struct(F.lit("content-length").alias("key"), F.lit("0").alias("value")),
        F.struct(F.lit("server").alias("key"), F.lit("proxy").alias("value")),
        F.struct(F.lit("etag").alias("key"), etag.alias("value")),
        F.struct(F.lit("last-modified").alias("key"), F.when(k != 3, (at - 86400).cast("string")).alias("value")))
    uri = (F.when(k == 1, F.regexp_replace("url", "^http:", "https:")).when(k == 2, F.concat("url", F.lit("#again")))
           .otherwise(F.regexp_replace("url", r"^([a-z]+://)", "$1www.")))
    revisits = (base.where(i % 4 != 0).withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), i % 4)))
                .select((i * 8 + k).alias("record_id"), uri.alias("uri"), F.lit("revisit").alias("type"),
                        F.lit(304).alias("status"), date.alias("date"),
                        F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("headers"),
                        F.lit(None).cast("string").alias("payload_digest")))
    return responses.unionByName(revisits)
