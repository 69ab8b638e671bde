"""Not-modified revisits of web captures, resolved to the response they refer to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loamlens.llm.common import read
from loamlens.session import durable

# fixed values: header fields a not-modified answer may renew in the stored response
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# fixed values: query parameters that don't change what is served
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid|sessionid)(=|\z)"


def canonical_url(url: str | Column) -> Column:
    """Host and path as lookup key: without scheme, www or m, default port, fragment, tracking
    parameters and closing slash; the host in lower case, the parameters sorted. Null stays null."""
    column = F.col(url) if isinstance(url, str) else url
    bare = F.regexp_replace(F.regexp_replace(F.trim(column), r"#.*\z", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    address = F.regexp_extract(bare, r"^([^?]*)", 1)
    host = F.lower(F.regexp_extract(address, r"^([^/]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)\z", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(address, r"^[^/]*(.*)\z", 1), r"/+\z", "")
    pairs = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"\?(.*)\z", 1), "&", -1),
                                  lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&")))
                    .otherwise(F.lit("")))


def _tag(column: Column) -> Column:
    """Entity tags are compared weakly."""
    return F.regexp_replace(column, r"^W/", "")


def merged_headers(original: Column, revisit: Column) -> Column:
    """The stored headers, with the fields a not-modified answer may renew taken from it."""
    lowered = lambda m: F.transform_keys(F.coalesce(
        m, F.create_map().cast("map<string,string>")), lambda k, v: F.lower(k))
    new = F.map_filter(lowered(revisit), lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(lowered(original), lambda k, v: ~F.map_contains_key(new, k)), new)


def latest_earlier(events: DataFrame) -> DataFrame:
    """As-of join of the events that aren't ``full`` to the latest strictly earlier full one of a ``url``.

    ``events`` has ``url``, ``at``, ``id``, ``full`` and ``data``; the result has the
    events that aren't full, and ``found``: ``at``, ``id`` and ``data`` of the full one, or null. Of several at the same time the largest id counts.

    The whole table is range-partitioned by url, time and id, so that one url with a third of all
    events spreads over many partitions. The last full event is found within each partition; what a
    partition ends with is carried on through a table of one row per url and partition.
    """
    order = ["at", F.col("full").cast("int"), "id"]
    placed = durable(events.repartitionByRange("url", *order).withColumn(
        "part", F.spark_partition_id()))
    one = F.when(F.col("full"), F.struct("at", "id", "data"))
    before = Window.partitionBy("part", "url").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    within = placed.withColumn("near", F.last(one, ignorenulls=True).over(before))
    ends = placed.where("full").groupBy("url", "part").agg(F.max(F.struct("at", "id", "data")).alias("end"))
    # a row for every partition of a url, also for one without a full event
    parts = placed.select("url", "part").distinct().join(ends, ["url", "part"], "left")
    past = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("url", "part", F.last("end", ignorenulls=True).over(past).alias("far"))
    joined = within.join(carried.where("far is not null"), ["url", "part"], "left")
    return joined.where("not full").select(*events.columns, F.coalesce("near", "far").alias("found"))


def resolve(records: DataFrame) -> DataFrame:
    """Every revisit of ``records`` with the response it stands for.

    ``records`` has ``record_id``, ``url``, ``at`` (comparable), ``kind`` (``response`` or
    ``revisit``), ``etag``, ``last_modified``, ``digest`` and ``headers`` (a map); payloads stay where
    they are and are found by ``original_id``. The first validator both sides state decides: entity
    tag, date of modification, digest.

    One row per revisit: ``record_id``, ``url``, ``at``, ``original_id``, ``original_at``, ``status``
    and ``headers``. Status is ``resolved``, ``mismatch`` (a validator differs), ``unchecked`` (none in
    common) or ``missing`` (no earlier response, or a null url or time); only resolved ones have merged
    headers. Records of other kinds are ignored, and so are responses without a url or time; repeated
    revisits are each resolved; responses at the time of the revisit itself aren't earlier.
    """
    columns = ["etag", "last_modified", "digest", "headers"]
    known = records.where(F.col("kind").isin("response", "revisit"))
    # hash maps aren't orderable, so headers travel as an array of entries
    entries = F.transform(F.array_sort(F.map_entries("headers")),
                          lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    events = known.select(canonical_url("url").alias("url"), "at", F.col("record_id").alias("id"),
                          (F.col("kind") == "response").alias("full"), F.col("url").alias("raw"),
                          F.struct(*columns[:3], entries.alias("headers")).alias("data"))
    placeable = F.col("url").isNotNull() & F.col("at").isNotNull()
    found = latest_earlier(events.where(placeable))
    lost = events.where(~placeable & ~F.col("full")).withColumn(
        "found", F.lit(None).cast(found.schema["found"].dataType))
    both = found.unionByName(lost)
    theirs = lambda c: F.col(f"found.data.{c}")
    ours = lambda c: F.col(f"data.{c}")
    same = F.coalesce(_tag(ours("etag")) == _tag(theirs("etag")),
                      ours("last_modified") == theirs("last_modified"),
                      ours("digest") == theirs("digest"))
    status = F.when(F.col("found").isNull(), "missing").when(same.isNull(), "unchecked").when(
        same, "resolved").otherwise("mismatch")
    headers = merged_headers(F.map_from_entries(F.coalesce(theirs("headers"), F.array().cast(
        "array<struct<key:string,value:string>>"))), F.map_from_entries(F.coalesce(
            ours("headers"), F.array().cast("array<struct<key:string,value:string>>"))))
    return both.select(
        F.col("id").alias("record_id"), F.col("raw").alias("url"), "at",
        F.col("found.id").alias("original_id"), F.col("found.at").alias("original_at"),
        status.alias("status"), F.when(status == "resolved", headers).alias("headers"))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl log derived from ``pages``: each page's response, and later revisits of its address.

    Record ``3 p`` is the response with page ``p``'s html; ``3 p + 1`` a revisit that states an entity
    tag, stale for every fifth page; ``3 p + 2``, for every third page, one that states a date only.
    Times are seconds fixed by ``page_id``, so that captures of one address interleave.
    """
    p = F.col("page_id")
    day = lambda c: F.concat(F.lit("day "), (c % 30).cast("string"))
    tag = F.md5(F.coalesce("html", F.lit("")))
    none = F.lit(None).cast("string")

    def record(offset, at, kind, etag, modified, digest, **headers):
        held = F.create_map(*[x for k, v in headers.items() for x in (F.lit(k.replace("_", "-")), v)])
        return F.struct((p * 3 + offset).alias("record_id"), at.alias("at"), F.lit(kind).alias("kind"),
                        etag.alias("etag"), modified.alias("last_modified"), digest.alias("digest"),
                        held.alias("headers"))

    at = p * 10
    response = record(0, at, "response", tag, day(p), tag, Content_Type=F.lit("text/html"), ETag=tag,
                      Cache_Control=F.lit("max-age=60"), Date=at.cast("string"))
    by_tag = record(1, at + 5 + (p % 7) * 1000, "revisit",
                    F.when(p % 5 == 0, F.lit("stale")).otherwise(F.concat(F.lit("W/"), tag)), none, tag,
                    Content_Type=F.lit("text/plain"), Cache_Control=F.lit("max-age=90"),
                    Date=(at + 5 + (p % 7) * 1000).cast("string"))
    by_date = record(2, at + 8 + (p % 11) * 5000, "revisit", none, day(p), none,
                     Expires=F.lit("0"), Date=(at + 8 + (p % 11) * 5000).cast("string"))
    return pages.select("url", F.explode(F.when(
        p % 3 == 0, F.array(response, by_tag, by_date)).otherwise(F.array(response, by_tag))).alias("r")
    ).select("url", "r.*")


def revisits_of_pages(spark, sf_dir: str) -> DataFrame:
    """The query: resolved revisits with their headers as one sorted text."""
    found = resolve(captures_of_pages(read(spark, sf_dir, "pages")))
    written = F.array_join(F.transform(F.array_sort(F.map_entries("headers")),
                                       lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return found.select("record_id", "url", "at", "original_id", "original_at", "status",
                        F.coalesce(written, F.lit("")).alias("headers"))
