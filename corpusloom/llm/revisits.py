"""Operator 4: resolution of WARC revisit records that a server answered with "not modified".

A revisit is resolved by an as-of join: the latest full response of the same canonical URL at a strictly earlier time. The
revisit's validator must agree with the response's: the entity tag by weak comparison, or, where the revisit has none,
Last-Modified. The merged record has the response's headers, updated with those of the revisit that a 304 may change.

No task gathers a URL's captures. Records of one URL and time first become one point: its latest response, and whether a revisit
asks there. Times are then cut by ``DIGIT_BITS`` binary digits a level, so a window over the times of one URL and higher digits
holds 2^DIGIT_BITS points at most, whatever the data. Where a window has no earlier response, the last one of an earlier window
comes from the next level, whose points are these windows; the span of times sets the number of levels. Payloads don't travel;
results name the response.

Status: ``resolved``, ``mismatch`` (validators differ), ``no_validator`` (nothing to check on either side), ``no_response``.

Defined cases: null urls match nothing; null times resolve to ``no_response``; of responses at one time the largest record_id is the
latest; repeated rows are resolved each for itself; null headers count as none, and of header
names that differ in case only the last stays; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.scratch import Scratch

#: Binary digits of time that a window spans.
DIGIT_BITS = 16
#: Headers that describe the stored payload: a 304 may not change them (fixed values).
PAYLOAD_HEADERS = ["content-encoding", "content-length", "content-range", "content-type", "transfer-encoding"]
#: Query parameters that don't choose a resource (fixed values).
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)="
#: Of the registered query: every page is asked for again after so many time steps.
REFETCH_AFTER = 1000


def canonical(url: Column) -> Column:
    """Host and path without scheme, "www.", default port, fragment, trailing slashes and tracking parameters; parameters sorted."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(bare, "^[^/?]*", 0)
    rest = F.substring(bare, F.length(host) + 1, F.length(bare))
    host = F.regexp_replace(F.regexp_replace(F.lower(host), r"^www\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^?]*", 0), "/+$", "")
    kept = F.array_sort(F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def lowered(headers: Column) -> Column:
    """Headers by lower-case name; of names that differ in case only the last stays."""
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(pairs, lambda e, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda o: o["key"] == e["key"]))
    return F.coalesce(F.map_from_entries(last), F.create_map().cast("map<string,string>"))


def earlier_responses(points: DataFrame, levels: int, scratch: Scratch) -> DataFrame:
    """(canonical_url, ts, r) of the asked points: ``r`` is the response of the last point before them that has one, or null.

    ``points``: canonical_url, ts, response (a struct or null), asked; one row for each URL and time.
    """
    window = F.shiftright("ts", DIGIT_BITS)
    group = ["canonical_url", window] if levels > 1 else ["canonical_url"]
    before = Window.partitionBy(*group).orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    near = points.withColumn("r", F.last("response", ignorenulls=True).over(before))
    if levels == 1:
        return near.where("asked").select("canonical_url", "ts", "r")
    near = scratch.save(near.where("asked").select("canonical_url", "ts", "r"), f"near-{levels}")
    lasts = points.groupBy("canonical_url", window.alias("ts")).agg(F.max_by("response", F.when(F.col("response").isNotNull(), F.col("ts"))).alias("response"), F.max("asked").alias("asked"))
    far = earlier_responses(lasts, levels - 1, scratch).where("r is not null").select("canonical_url", F.col("ts").alias("window"), F.col("r").alias("far"))
    return near.withColumn("window", window).join(far, ["canonical_url", "window"], "left").select("canonical_url", "ts", F.coalesce("r", "far").alias("r"))


def resolve(records: DataFrame, scratch: Scratch) -> DataFrame:
    """``records``: record_id, ts (long), url, kind (response or revisit), etag, last_modified, headers (map).

    Result, a row for each revisit: record_id, ts, canonical_url, response_id, status, headers (merged; null unless resolved).
    """
    slim = records.select(F.col("record_id").cast("long").alias("record_id"), F.col("ts").cast("long").alias("ts"), canonical(F.col("url")).alias("canonical_url"), "kind", weak(F.col("etag")).alias("etag"), "last_modified", lowered(F.col("headers")).alias("headers")).where(F.col("kind").isin("response", "revisit"))
    slim = scratch.save(slim, "records")
    first, last = slim.agg(F.min("ts"), F.max("ts")).first()
    levels = 1
    while first is not None and (last >> DIGIT_BITS * (levels - 1)) - (first >> DIGIT_BITS * (levels - 1)) >= 1 << DIGIT_BITS:
        levels += 1
    response = F.when(F.col("kind") == "response", F.struct("record_id", "etag", "last_modified", "headers"))
    points = slim.where("ts is not null and canonical_url is not null").groupBy("canonical_url", "ts").agg(F.max_by(response, F.when(F.col("kind") == "response", F.struct("record_id"))).alias("response"), F.max(F.col("kind") == "revisit").alias("asked"))
    found = slim.where("kind = 'revisit'").join(earlier_responses(scratch.save(points, "points"), levels, scratch), ["canonical_url", "ts"], "left")
    by_tag, by_date = F.col("etag").isNotNull() & F.col("r.etag").isNotNull(), F.col("last_modified").isNotNull() & F.col("r.last_modified").isNotNull()
    agrees = F.when(by_tag, F.col("etag") == F.col("r.etag")).when(by_date & F.col("etag").isNull(), F.col("last_modified") == F.col("r.last_modified"))
    status = F.when(F.col("r").isNull(), "no_response").when(agrees.isNull(), "no_validator").when(agrees, "resolved").otherwise("mismatch")
    news = F.map_filter("headers", lambda k, v: ~k.isin(*PAYLOAD_HEADERS))
    old = F.map_filter("r.headers", lambda k, v: ~F.array_contains(F.map_keys(news), k))
    return found.select("record_id", "ts", "canonical_url", F.col("r.record_id").alias("response_id"), status.alias("status"), F.when(status == "resolved", F.map_concat(old, news)).alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """Records made of pages: each is a response at the time of its id, and is asked for again REFETCH_AFTER later."""
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.md5(F.coalesce(F.col("html"), F.lit("")).cast("binary")).alias("tag"), F.octet_length(F.coalesce(F.col("html"), F.lit(""))).alias("bytes"))
    head = lambda *kv: F.create_map(*(F.lit(x) if isinstance(x, str) else x for x in kv))
    full = page.select(F.col("page_id").alias("record_id"), F.col("page_id").alias("ts"), "url", F.lit("response").alias("kind"), F.col("tag").alias("etag"), F.lit(None).cast("string").alias("last_modified"), head("Content-Length", F.col("bytes").cast("string"), "Date", F.col("page_id").cast("string"), "ETag", F.col("tag")).alias("headers"))
    again = page.select(F.col("page_id").alias("record_id"), (F.col("page_id") + REFETCH_AFTER).alias("ts"), "url", F.lit("revisit").alias("kind"), F.concat(F.lit("W/"), "tag").alias("etag"), F.lit(None).cast("string").alias("last_modified"), head("Content-Length", F.lit("0"), "Date", (F.col("page_id") + REFETCH_AFTER).cast("string")).alias("headers"))
    return full.unionByName(again)


def query(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """page_id, canonical_url, response_id, status, headers (sorted name=value, by semicolons)."""
    rows = resolve(captures(pages), scratch)
    written = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return rows.select(F.col("record_id").alias("page_id"), "canonical_url", "response_id", "status", written.alias("headers"))


def oracle() -> str:
    return rf"""
with b as (select page_id, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') u, md5(coalesce(html, '')) tag, strlen(coalesce(html, '')) n from pages),
h as (select *, regexp_extract(u, '^[^/?]*') host from b),
p as (select *, substr(u, length(host) + 1) rest from h),
q as (select *, list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda z: z <> '' and not regexp_matches(z, '{TRACKING}'))) kept from p),
c as (select page_id, tag, n, regexp_replace(regexp_replace(lower(host), '^www\.', ''), ':(80|443)$', '') || regexp_replace(regexp_extract(rest, '^[^?]*'), '/+$', '') || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end canonical_url from q),
j as (select a.page_id, a.canonical_url, a.tag, max(r.page_id) response_id from c a left join c r on r.canonical_url = a.canonical_url and r.page_id < a.page_id + {REFETCH_AFTER} group by all)
select j.page_id, j.canonical_url, response_id, case when response_id is null then 'no_response' when r.tag = j.tag then 'resolved' else 'mismatch' end status,
case when r.tag = j.tag then 'content-length=' || r.n || ';date=' || (j.page_id + {REFETCH_AFTER}) || ';etag=' || r.tag end headers from j left join c r on r.page_id = response_id"""
