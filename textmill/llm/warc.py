"""Not-modified revisits of a WARC crawl, resolved by an as-of join on the canonical URL, in DataFrame operations.

A revisit record carries headers and validators but no payload. It is resolved to the latest earlier full response of
the same canonical URL, if the validators agree: the revisit's ETag (weak comparison) where both have one, else its
Last-Modified, else its payload digest. The permitted headers of the revisit replace those of the response.

The history of one URL can be a third of all records, so records are dealt by ranges of (URL, time) whatever URL they
are of: the last response of each range is carried to the following ones on a table of ranges, and only the rest is done
inside a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import written

# fixed values: header fields that a 304 answer may update (RFC 9110 15.4.5, RFC 9111 3.2)
MERGED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning")
# fixed values: query parameters that name a visit, not a resource
TRACKING = ("utm_[a-z]+", "gclid", "fbclid", "ref", "sessionid", "phpsessid")


def canonical_url(url: Column) -> Column:
    """http and https alike, host in lower case without www., user, default port; no fragment, no tracking
    parameters, the others sorted; no trailing slash. Null stays null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^(?i)https?://", "")
    split = F.split(bare, "\\?", 2)
    place = F.get(split, F.lit(0))
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(place, "^[^/]*", 0)), "^.*@", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(place, "/.*$", 0), "/+$", "")
    keep = F.filter(F.split(F.coalesce(F.get(split, F.lit(1)), F.lit("")), "&"), lambda p: (p != "") & ~p.rlike("^(?i)(" + "|".join(TRACKING) + ")(=|$)"))
    query = F.array_join(F.array_sort(keep), "&")
    return F.concat(F.regexp_replace(host, "^www\\.", ""), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def merged_headers(old: Column, new: Column) -> Column:
    """Headers of the stored response with the permitted ones of the revisit in their place; names in lower case."""
    # names that differ only in case are one field: the value of the last name in code-point order
    entries = lambda m: F.array_sort(F.transform(F.map_entries(F.coalesce(m, F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.lower(e["key"]).alias("k"), e["key"].alias("as_sent"), e["value"].alias("v"))))
    one = lambda es: F.filter(es, lambda e, i: ~F.coalesce(F.get(es, i + 1)["k"] == e["k"], F.lit(False)))
    low = lambda m: F.map_from_entries(F.transform(one(entries(m)), lambda e: F.struct(e["k"], e["v"])))
    fresh = F.map_filter(low(new), lambda k, v: k.isin(*MERGED) & v.isNotNull())
    kept = F.map_filter(low(old), lambda k, _: ~F.array_contains(F.map_keys(fresh), k))
    return F.map_concat(kept, fresh)


def resolve_revisits(records: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per revisit: record_id, canon, ts, response_id, resolved, reason, headers.

    records: record_id, ts (both orderable), url, kind ('response' or 'revisit'; others are left out), etag,
    last_modified, digest, headers (map of strings). Records of a URL are ordered by ts (null first), then responses
    before revisits, then record_id (null first); rows equal in all of these are in no order. reason: null if resolved,
    else 'no url' (null or blank url), 'no earlier response', 'validators differ' or 'no validator'; response_id is the
    candidate in the last two cases and headers are then the permitted ones of the revisit. Header names are given in
    lower case; of names that differ only in case the last in code-point order stands. Other columns are not read;
    repeated rows give repeated results; an empty table gives none. ranges: into how many the records are dealt; by
    default as many as the session's shuffles have partitions.
    """
    ok = F.coalesce(F.col("canon") != "", F.lit(False))
    recs = records.select("record_id", "ts", "kind", "etag", "last_modified", "digest", "headers", canonical_url(F.col("url")).alias("canon")).where(F.col("kind").isin("response", "revisit"))
    recs = recs.withColumn("again", F.col("kind") == "revisit").where(ok | F.col("again"))
    order = ["ts", "again", "record_id"]
    # the one table written: revisits without a URL lie in it too, and the records are read for it and its bounds only
    recs = recs.repartitionByRange(*([ranges] if ranges else []), "canon", *order).withColumn("run", F.spark_partition_id())
    recs = written(recs, "runs")
    full = F.struct("record_id", "etag", "last_modified", "digest", "headers")
    # null orders below all other values in a structure too; runs without a response have a null end
    spans = recs.where(ok).groupBy("canon", "run").agg(F.max_by(full, F.when(~F.col("again"), F.struct("ts", "record_id"))).alias("end"))
    before = F.last("end", ignorenulls=True).over(Window.partitionBy("canon").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    carried = spans.select("canon", "run", before.alias("carried"))
    inside = F.last(F.when(~F.col("again"), full), ignorenulls=True).over(Window.partitionBy("canon", "run").orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, -1))
    # left: revisits without a URL are in no span
    asof = recs.withColumn("inside", inside).where("again").join(carried, ["canon", "run"], "left").withColumn("r", F.coalesce("inside", "carried"))
    r = F.col("r")
    verdict = (
        F.when(~ok, "no url")
        .when(r.isNull(), "no earlier response")
        .when(F.col("etag").isNotNull() & r["etag"].isNotNull(), F.when(_weak(F.col("etag")) != _weak(r["etag"]), "validators differ"))
        .when(F.col("last_modified").isNotNull() & r["last_modified"].isNotNull(), F.when(F.col("last_modified") != r["last_modified"], "validators differ"))
        .when(F.col("digest").isNotNull() & r["digest"].isNotNull(), F.when(F.col("digest") != r["digest"], "validators differ"))
        .otherwise("no validator")
    )
    found = asof.select("record_id", "canon", "ts", r["record_id"].alias("response_id"), verdict.alias("reason"), F.col("headers").alias("own"), r["headers"].alias("stored"))
    resolved = F.col("reason").isNull()
    return found.select(
        "record_id", "canon", "ts", "response_id", resolved.alias("resolved"), "reason", merged_headers(F.when(resolved, F.col("stored")), F.col("own")).alias("headers")
    )


def page_records(pages: DataFrame) -> DataFrame:
    """Two crawls of every page as WARC records: a full response at ts = page_id and a conditional request later.

    The second visit of page p comes 100,000 later; it was answered 304 with the validators the site gives then: the
    ETag is the payload's MD5 (weak for even ids), Last-Modified the decade of the id, and every seventh page sends
    none. Pages of one canonical URL thus revisit whichever of them was the latest full response.
    """
    p = pages.select("page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("md5"))
    etag = F.when(F.col("page_id") % 7 != 3, F.concat(F.when(F.col("page_id") % 2 == 0, "W/").otherwise(""), F.lit('"'), "md5", F.lit('"')))
    modified = F.when(F.col("page_id") % 7 != 3, F.concat(F.lit("day "), F.floor(F.col("page_id") / 10).cast("string")))
    p = p.select("page_id", "url", etag.alias("etag"), modified.alias("last_modified"), F.when(F.col("page_id") % 5 != 4, F.col("md5")).alias("digest"))
    page = F.col("page_id")
    head = lambda kind: F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Date"), F.concat(F.lit(kind), page.cast("string")), F.lit("X-Cache"), F.lit(kind))
    visit = lambda i, ts, kind, name: F.struct((page * 2 + i).alias("record_id"), ts.alias("ts"), F.lit(kind).alias("kind"), "url", "etag", "last_modified", "digest", head(name).alias("headers"))
    # both visits from one scan
    return p.select(F.inline(F.array(visit(0, page, "response", "full"), visit(1, page + 100_000, "revisit", "again"))))
