"""Resolution of not-modified web captures.

A revisit record holds the headers of a 304 answer and no payload. It stands
for the latest earlier full response of the same canonical URL if their
validators agree; headers that a 304 may update replace those stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.llm.common import stored

#: Fixed list: fields a 304 answer carries to update the stored response.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
#: Query parameters that only track where a visit came from.
TRACKING = "^utm_"


def canonical_url(url: str | Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without final slashes, sorted query.

    Scheme, fragment and tracking parameters are left out. A string without
    ``://`` is taken as it stands, null stays null.
    """
    url = F.col(url) if isinstance(url, str) else url
    bare = F.regexp_replace(url, "#.*$", "")
    host = F.lower(F.regexp_extract(bare, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^:]+://[^/?]*([^?]*)", 1), "/+$", "")
    given = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(given, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(url.contains("://"), F.concat(host, path, query)).otherwise(url)


def header_fields(block: str) -> Column:
    """Fields of an HTTP header block as (name in lower case, value), in order; lines without a name are left out."""
    lines = F.filter(F.split(F.coalesce(F.col(block), F.lit("")), "\r?\n"), lambda h: h.rlike(r"^[^:\s]+:"))
    return F.transform(lines, lambda h: F.struct(
        F.lower(F.substring_index(h, ":", 1)).alias("name"),
        F.trim(F.regexp_replace(h, r"^[^:]*:", "")).alias("value")))


def _field(fields: str, name: str) -> Column:
    return F.get(F.filter(fields, lambda h: h["name"] == name), F.lit(0))["value"]


def _tag(tag: Column) -> Column:
    """Entity tags compare without their mark of weakness."""
    return F.regexp_replace(tag, "^W/", "")


def resolve(records: DataFrame, carry: tuple[str, ...] = ("payload",)) -> DataFrame:
    """Every record with what it stands for.

    ``records``: record_id, record_type (``response`` or ``revisit``), url,
    date (timestamp), headers (text block) and the ``carry`` columns. Returns
    record_id, record_type, canonical_url, date, outcome, source_id, fields
    (name, value) and the ``carry`` columns, the latter from the source where
    a revisit is resolved, else its own. outcome:

    * ``full``: a response; it is its own source
    * ``resolved``: a revisit whose ETag equals the source's (weakly compared), or, without
      one, whose Last-Modified does
    * ``changed``: the validator differs from the source's or the source has none
    * ``unvalidated``: the revisit has no validator
    * ``unmatched``: no full response of this URL at an earlier instant, or URL or date is null

    Among responses of one URL and instant the one of the largest record_id
    is the latest. Other record types and columns are left out; record_id
    should be unique: repeated rows of a source repeat what it resolves.

    A URL with very many captures is split: captures are ranged by URL and
    date, looked up inside their range, then in what earlier ranges end with.
    """
    rows = records.where(F.col("record_type").isin("response", "revisit")).select(
        "record_id", "record_type", canonical_url("url").alias("canonical_url"), "date",
        header_fields("headers").alias("fields"), *carry)
    full = F.col("record_type") == "response"
    narrow = rows.where(F.col("canonical_url").isNotNull() & F.col("date").isNotNull()).select(
        F.col("canonical_url").alias("url"), F.unix_micros(F.col("date").cast("timestamp")).alias("at"), "record_id",
        full.alias("full"), _tag(_field("fields", "etag")).alias("tag"),
        _field("fields", "last-modified").alias("modified"))
    ranged = stored(narrow.repartitionByRange("url", "at").withColumn("range", F.spark_partition_id()), "captures")
    capture = F.when(F.col("full"), F.struct("at", "record_id", "tag", "modified"))
    here = Window.partitionBy("url", "range").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    # One row for each URL and range: what the range ends with, and what stands before it.
    ends = ranged.groupBy("url", "range").agg(F.max(capture).alias("last"))
    earlier = Window.partitionBy("url").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = stored(ends.select("url", "range", F.max("last").over(earlier).alias("before")).where("before is not null"),
                  "range-ends")
    inside = stored(ranged.withColumn("found", F.max(capture).over(here)).where("not full"), "inside")
    source = F.coalesce("found", "before")
    outcome = F.when(F.col("source").isNull(), "unmatched").when(
        F.col("tag").isNotNull(), F.when(F.col("tag") == F.col("source.tag"), "resolved").otherwise("changed")).when(
        F.col("modified").isNotNull(),
        F.when(F.col("modified") == F.col("source.modified"), "resolved").otherwise("changed")).otherwise("unvalidated")
    judged = inside.join(ends, ["url", "range"], "left").withColumn("source", source).select(
        "record_id", outcome.alias("outcome"), F.col("source.record_id").alias("source_id"))
    judged = stored(judged.distinct(), "judged")

    own = rows.where(full).withColumns({"outcome": F.lit("full"), "source_id": F.col("record_id")})
    visits = stored(rows.where(~full).join(judged, "record_id", "left").withColumn(
        "outcome", F.coalesce("outcome", F.lit("unmatched"))), "visits")
    given = rows.where(full).select(F.col("record_id").alias("source_id"), F.lit("resolved").alias("outcome"),
                                    F.col("fields").alias("stored_fields"), *(F.col(c).alias(f"source_{c}") for c in carry))
    update = F.filter("fields", lambda h: h["name"].isin(PERMITTED))
    names = F.transform(update, lambda h: h["name"])
    merged = F.concat(F.filter("stored_fields", lambda h: ~F.array_contains(names, h["name"])), update)
    columns = ["record_id", "record_type", "canonical_url", "date", "outcome", "source_id"]
    resolved = F.col("outcome") == "resolved"
    # Only resolved visits find a partner: the outcome is part of the key.
    found = visits.join(given, ["source_id", "outcome"], "left").select(
        *columns, F.when(resolved, merged).otherwise(F.col("fields")).alias("fields"),
        *(F.when(resolved, F.col(f"source_{c}")).otherwise(F.col(c)).alias(c) for c in carry))
    return own.select(*columns, "fields", *carry).unionByName(found)
