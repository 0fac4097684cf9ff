"""Not-modified revisits of a web archive, resolved to the responses they stand for.

A revisit record holds headers and no payload: the server has said that what it sent before still
holds. Its payload is that of the latest earlier full response of the same canonical URL, if the
validators agree, and its headers are that response's, updated as HTTP allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import stage

#: Header fields that a 304 answer must not change in the stored response: they describe the
#: stored payload or one connection only.
KEPT = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "etag", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
)
#: Query parameters that only say where a visitor came from.
TRACKING = r"^(?:utm_[^=]*|gclid|fbclid|ref)(?:=|$)"
#: Seconds of a block of the as-of join.
BLOCK = 86400


def canonical_url(url: Column) -> Column:
    """Scheme-free URL with lower-case host, no default port, user, fragment or tracking parameters, sorted query, no slash at the end."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, r"^[^/?@]*@", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r":(?:80|443)$|\.$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")
    query = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _lower_keys(headers: Column) -> Column:
    """Headers with lower-case names; of names that differ in case only, the last in order of the names."""
    return F.map_from_entries(F.aggregate(
        F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))),
        F.array().cast("array<struct<key:string,value:string>>"),
        lambda kept, e: F.concat(
            F.filter(kept, lambda k: k["key"] != F.lower(e["key"])),
            F.array(F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))),
        ),
    ))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored response's headers, with those of the revisit that may change instead of or added to its own."""
    allowed = F.map_filter(fresh, lambda k, v: ~k.isin(*KEPT) & v.isNotNull())
    own = F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k))
    return F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(own, allowed))))


def _verdict(etag: Column, modified: Column, stored_etag: Column, stored_modified: Column) -> Column:
    """Entity tags decide where both sides have one (weak comparison), else dates, else nothing does."""
    strong = lambda tag: F.regexp_replace(tag, "^W/", "")
    return (
        F.when(etag.isNotNull() & stored_etag.isNotNull(), F.when(strong(etag) == strong(stored_etag), "resolved").otherwise("changed"))
        .when(modified.isNotNull() & stored_modified.isNotNull(), F.when(modified == stored_modified, "resolved").otherwise("changed"))
        .otherwise("unverified")
    )


def resolve(records: DataFrame) -> DataFrame:
    """What every record of ``records`` (record_id, kind, url, fetched_at, headers) stands for.

    ``kind`` is ``response`` or ``revisit``; ``fetched_at`` a timestamp or number; ``headers`` a
    map of strings. Adds ``canonical``, ``source_id`` (the record that has the payload), ``status``
    and ``merged``. Status: ``full`` for a response, its own source; ``resolved``; ``changed``, the
    validators of the latest earlier response differ; ``unverified``, there are none to compare;
    ``unmatched``, there is no earlier response; both without a source. Responses of one moment
    are told apart by the larger record_id; one of the revisit's own moment is not earlier. A null
    url or time matches nothing, a kind of another name counts as unmatched; null headers are
    none; repeated records each get their answer; an empty table gives an empty one.

    Only ids, times and validators travel to the as-of join, not payloads. URLs are joined in
    blocks of BLOCK seconds: inside a block a window sees its records, across blocks a table with
    a row per URL and block carries the last response on, so a URL that has a third of all records
    does not go to one task. Headers of the responses found are joined at the end, by id.
    """
    headers = _lower_keys(F.col("headers"))
    rows = stage(records.select(
        F.col("record_id").cast("bigint").alias("record_id"), F.col("kind").cast("string").alias("kind"),
        canonical_url(F.col("url")).alias("canonical"), F.col("fetched_at").cast("timestamp").cast("double").alias("at"),
        headers.alias("headers"), F.monotonically_increasing_id().alias("uid"),
    ).withColumn("etag", F.col("headers")["etag"]).withColumn("modified", F.col("headers")["last-modified"]), "warc-records")
    block = F.floor(F.col("at") / BLOCK)
    narrow = rows.filter("canonical is not null and at is not null and kind in ('response', 'revisit')").select(
        "uid", "record_id", "kind", "canonical", "at", "etag", "modified", block.alias("block")
    )
    full = F.col("kind") == "response"
    found = F.struct("at", "record_id", "uid", "etag", "modified")
    # Revisits sort before responses of their own moment, so those are not earlier.
    inside = Window.partitionBy("canonical", "block").orderBy("at", full.cast("int"), "record_id", "uid")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    last = narrow.filter(full).groupBy("canonical", "block").agg(F.max(found).alias("ended"))
    blocks = narrow.select("canonical", "block").distinct().join(last, ["canonical", "block"], "left")
    chain = Window.partitionBy("canonical").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = stage(
        blocks.select("canonical", "block", F.last("ended", ignorenulls=True).over(chain).alias("carried")), "warc-carried"
    )
    near = narrow.withColumn("near", F.last(F.when(full, found), ignorenulls=True).over(before)).filter(~full)
    hit = near.join(carried, ["canonical", "block"]).withColumn("hit", F.coalesce("near", "carried"))
    status = F.when(F.col("hit").isNull(), "unmatched").otherwise(
        _verdict(F.col("etag"), F.col("modified"), F.col("hit")["etag"], F.col("hit")["modified"])
    )
    answers = stage(hit.select("uid", status.alias("status"), F.col("hit")["uid"].alias("source_uid"), F.col("hit")["record_id"].alias("source_id")), "warc-answers")
    used = answers.filter("status = 'resolved'")
    sources = rows.join(used.select(F.col("source_uid").alias("uid")).distinct(), "uid", "left_semi").select(
        F.col("uid").alias("source_uid"), F.col("headers").alias("stored")
    )
    told = answers.join(sources, "source_uid", "left").select("uid", "status", "source_id", "stored")
    own = F.col("kind") == "response"
    joined = rows.join(told, "uid", "left")
    status = F.when(own, "full").otherwise(F.coalesce("status", F.lit("unmatched")))
    done = F.col("status") == "resolved"
    return joined.select(
        "record_id", "kind", "canonical", "at", status.alias("status"),
        F.when(own, F.col("record_id")).when(done, F.col("source_id")).alias("source_id"),
        F.when(own, F.map_from_entries(F.array_sort(F.map_entries("headers"))))
        .when(done, merged_headers(F.col("stored"), F.col("headers"))).alias("merged"),
    )


def records_of(pages: DataFrame) -> DataFrame:
    """Archive records made from crawled pages: a response of each page and three later visits.

    Times follow page ids. The first visit agrees with the page's entity tag, the second has
    another one, the third only a date. A page with a null url or html has records that match nothing.
    """
    at = F.col("page_id") * 600 + 1_600_000_000
    tag, date = F.concat(F.lit('"'), F.md5("html"), F.lit('"')), F.date_format(F.timestamp_seconds(at), "yyyy-MM-dd HH:mm:ss")
    common = lambda k: (F.lit("Date"), F.date_format(F.timestamp_seconds(at + k * 3600), "yyyy-MM-dd HH:mm:ss"))
    response = F.create_map(
        F.lit("ETag"), tag, F.lit("Last-Modified"), date, F.lit("Content-Type"), F.lit("text/html"),
        F.lit("Content-Length"), F.octet_length("html").cast("string"), *common(0),
    )
    same = F.create_map(F.lit("etag"), F.concat(F.lit("W/"), tag), F.lit("Content-Length"), F.lit("0"), F.lit("Cache-Control"), F.lit("max-age=60"), *common(1))
    other = F.create_map(F.lit("ETag"), F.lit('"other"'), *common(2))
    dated = F.create_map(F.lit("Last-Modified"), date, *common(3))
    made = [
        F.struct(F.lit(k).alias("k"), F.lit("revisit" if k else "response").alias("kind"), headers.alias("headers"))
        for k, headers in enumerate((response, same, other, dated))
    ]
    each = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.explode(F.array(*made)).alias("m"), at.alias("at"))
    return each.select(
        (F.col("page_id") * 4 + F.col("m.k")).alias("record_id"), F.col("m.kind").alias("kind"), "url",
        F.timestamp_seconds(F.col("at") + F.col("m.k") * 3600).alias("fetched_at"), F.col("m.headers").alias("headers"),
    )
