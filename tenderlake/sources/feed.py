"""Tender feeds: landed XML files and their field extraction."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderlake.functions import dates, text
from tenderlake.operators import ranking
from tenderlake.schema import FEED_ITEM

ITEM_TAG = "item"

#: Character data and comments, passed over as wholes, and an opening tag with what follows it up to the next one. All
#: repetitions are possessive, so that long items are matched in a loop.
_SKIPPED = r"<!\[CDATA\[(?:[^\]]|\](?!\]>))*+\]\]>|<!--(?:[^-]|-(?!->))*+-->"
_ITEM = rf"{_SKIPPED}|<{ITEM_TAG}(?=[\s>])[^>]*+>(?:[^<]++|{_SKIPPED}|<(?!{ITEM_TAG}[\s>]))*+"

#: Single-byte encodings that a feed may declare, by their registered names.
ENCODINGS = ["windows-1250", "windows-1251", "windows-1252", "koi8-r", "koi8-u", "iso-8859-1", "iso-8859-2", "iso-8859-5",
             "iso-8859-15", "cp866"]
#: Files of another encoding up to this number are handed to the tasks as a table.
FEW_FILES = 1000
#: Limits up to this number are kept by every task and merged by one; larger ones are cut by days.
FEW = 10_000
_DECLARED = r"^\s*<\?xml[^>]*encoding\s*=\s*[\"']([A-Za-z0-9._-]+)[\"']"


def decoded(raw: Column, encoding: Column) -> Column:
    """Text of raw bytes in one of ``ENCODINGS``: read as Latin-1, then each of its upper 128 signs is replaced."""
    latin = F.decode(raw, "ISO-8859-1")
    upper = bytes(range(128, 256))
    out = F.lit(None).cast("string")
    for name in ENCODINGS:
        # An undefined byte becomes U+FFFD, as everywhere.
        out = F.when(encoding == name, F.translate(latin, upper.decode("latin-1"), upper.decode(name, "replace"))).otherwise(out)
    return out


def _told(split: DataFrame, spark: SparkSession) -> DataFrame:
    """(value, valid): pieces of files as text, and whether their bytes are text in the encoding of their file.

    Files in another encoding than UTF-8 are looked up first. Mostly there are
    none or few, and then the texts stay where they are read.
    """
    name = F.lower(F.regexp_extract("value", _DECLARED, 1))
    declared = split.where(F.substring("value", 1, 200).contains("<?xml")).select("file", name.alias("encoding")).where(
        ~F.col("encoding").isin("", "utf-8", "utf8", "us-ascii")).groupBy("file").agg(F.min("encoding").alias("encoding"))
    first = declared.limit(FEW_FILES + 1).collect()
    if not first:
        return split.select(F.make_valid_utf8("value").alias("value"), F.is_valid_utf8("value").alias("valid"))
    if len(first) <= FEW_FILES:
        declared = F.broadcast(spark.createDataFrame(first, declared.schema))
    valid = F.when(F.col("encoding").isNull(), F.is_valid_utf8("value")).otherwise(F.col("encoding").isin(ENCODINGS))
    return split.join(declared, "file", "left").select(
        F.when(valid & F.col("encoding").isNotNull(), decoded(F.col("value").cast("binary"), F.col("encoding")))
        .otherwise(F.make_valid_utf8("value")).alias("value"), valid.alias("valid"))


def read_feed(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Items of landed feed files, one row each; ``limit`` keeps the newest.

    An item begins at each opening tag outside character data and ends with its
    end tag. Each is parsed by itself, so a malformed one costs no other: it
    comes as a row whose ``faulty`` holds its text and whose fields are NULL.
    That is so for an item without its end tag, too, except the last of a file
    if its fields are complete. Files are read in the encoding that they
    declare, UTF-8 by default; items in an unknown encoding, or with bytes that
    are no text in theirs, are faulty.
    """
    split = spark.read.text(path, lineSep=f"</{ITEM_TAG}>").select("value", F.col("_metadata.file_path").alias("file"))
    told = _told(split, spark)
    parts = F.regexp_extract_all("value", F.lit(_ITEM), F.lit(0))
    # Without character data and comments, a single opening tag begins the single item: nothing has to be matched.
    tag = f"<{ITEM_TAG}>"
    before, rest = F.substring_index("value", tag[:-1], 1), F.substring_index("value", tag, -1)
    single = ~F.contains("value", F.lit("<!")) & ~F.contains(rest, F.lit(tag[:-1])) & (
        F.octet_length(before) + F.octet_length(F.lit(tag)) + F.octet_length(rest) == F.octet_length("value"))
    bodies = F.when(single, F.array(F.concat(F.lit(tag), rest))).otherwise(F.filter(parts, lambda p: ~p.startswith("<!")))
    found = told.select("valid", bodies.alias("bodies"))
    # Outer, as Spark would else test the pieces before they are exploded, and so match each text several times.
    pieces = found.select("valid", F.size("bodies").alias("n"), F.posexplode_outer("bodies").alias("at", "body")) \
        .where("body IS NOT NULL")
    # Only the last one before an end tag is closed by it.
    whole = pieces.select("body", F.when(F.col("valid") & (F.col("at") == F.col("n") - 1) & ~F.contains("body", F.lit("\ufffd")),
                                         F.concat("body", F.lit(f"</{ITEM_TAG}>"))).alias("xml"))
    parsed = whole.select("body", F.from_xml("xml", FEED_ITEM.simpleString(), {"rowTag": ITEM_TAG}).alias("item"))
    read = [f.name for f in FEED_ITEM.fields]
    fault = reduce(lambda a, b: a & b, [F.col(f"item.{c}").isNull() for c in read])
    items = parsed.select(*[F.col(f"item.{c}").alias(c) for c in read], F.when(fault, F.col("body")).alias("faulty"))
    return items if limit is None else newest(items, limit)


def day(items: DataFrame) -> Column:
    """Day of an item: its column ``__day`` where it was derived before."""
    return F.col("__day") if "__day" in items.columns else dates.feed_date("published")


def newest(items: DataFrame, limit: int) -> DataFrame:
    """The newest items; among those of one day, and those without a date, the first by link.

    A large limit is cut by the counts of the days: what is newer than the day
    at the limit is taken as it is, and only that day's items are ranked, over
    all tasks. The items are read up to three times then: store what is dear
    to compute.
    """
    # A column, as a sort derives an expression at every comparison.
    dated = items.withColumn("__newest", day(items))
    order, by_day = ["link", "title"], F.desc_nulls_last("__newest")
    if limit <= FEW:
        return dated.orderBy(by_day, *order).limit(limit).drop("__newest")
    counts = dated.groupBy("__newest").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy(by_day).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = counts.withColumn("upto", upto).where(F.col("upto") >= limit).orderBy("upto").first()
    if last is None:
        return items
    edge = F.lit(last["__newest"]).cast("date")
    newer, same = F.col("__newest").isNotNull() if last["__newest"] is None else F.col("__newest") > edge, F.col("__newest").eqNullSafe(edge)
    if last["upto"] == limit:
        return dated.where(newer | same).drop("__newest")
    ranked = ranking.row_number_by(dated.where(same), [], order, "__at")
    taken = ranked.where(F.col("__at") <= limit - last["upto"] + last["n"]).drop("__at")
    return dated.where(newer).unionByName(taken).drop("__newest")


def item_number() -> Column:
    return text.purchase_number("link", "title", "description", "published")


def feed_versions(items: DataFrame, carry: bool = False) -> DataFrame:
    """Items with their tender number and content hash, which tell known items from new ones.

    With ``carry`` the visible text and the price stay, for ``feed_records`` to use again.
    """
    visible = items.withColumn("__text", text.strip_tags(F.coalesce("description", F.lit(""))))
    keyed = visible.withColumns({"tender_no": item_number(), "__price": text.labelled_price("__text")})
    found = keyed.withColumn("content_hash", text.content_hash("tender_no", _title(), "__price"))
    return found if carry else found.drop("__text", "__price")


def feed_records(items: DataFrame, source: str, clock: Column | datetime, keep: tuple[str, ...] = (),
                 cut: bool = False) -> DataFrame:
    """Tender records of feed items, plus item columns to ``keep``.

    The labelled fields come from the visible text of the description; what a
    feed does not say gets its default. ``cut`` shortens customer, region and title
    to the lengths of the dashboard; by default they are kept whole.
    """
    # One projection per step: each text is derived once, then read several times.
    known = {"__price", "tender_no"} <= set(items.columns)
    visible = items if "__text" in items.columns else items.withColumn("__text", text.strip_tags(F.coalesce("description", F.lit(""))))
    found = visible.withColumns({
        "__lower": F.lower("__text"),
        "__customer": text.labelled_text("__text", text.CUSTOMER_LABEL),
        "__region": text.labelled_text("__text", text.REGION_LABEL)})
    return found.select(
        F.col("tender_no") if known else item_number().alias("tender_no"),
        text.text_or_default("__customer", text.CUSTOMER_MAX if cut else None).alias("organization"),
        text.cut(_title(), text.TITLE_MAX if cut else None).alias("description"),
        text.classify("__lower").alias("category"),
        text.text_or_default("__region", text.REGION_MAX if cut else None).alias("region"),
        (F.col("__price") if known else text.labelled_price("__text")).alias("budget"),
        F.lit(text.ANNOUNCED).alias("status"),
        day(items).alias("published_on"),
        F.lit(source).alias("source"),
        F.col("link").alias("url"),
        F.col("description").alias("raw_description"),
        (clock if isinstance(clock, Column) else F.lit(clock)).alias("loaded_at"),
        *keep)


def _title() -> Column:
    return F.coalesce("title", F.lit(""))
