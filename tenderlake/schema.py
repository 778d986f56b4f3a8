"""Record types of the tender lake."""

from __future__ import annotations

from pyspark.sql import types as T

TENDER = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("tender_no", T.StringType()),
    T.StructField("organization", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("budget", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("source", T.StringType()),
])

# Every load of a stored layer owns one folder ``run_id=...``: a repeated load
# replaces its own rows, readers can prune by load.
RUN = T.StructField("run_id", T.StringType())

# Raw layer: a tender plus the load stamp and the batch origin.
RAW_LAYER = T.StructType(TENDER.fields + [
    T.StructField("loaded_at", T.TimestampType()),
    T.StructField("load_source", T.StringType()),
    RUN,
])

PROCESSED_LAYER = T.StructType([
    T.StructField("tender_no", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("budget", T.DoubleType()),
    T.StructField("budget_mln", T.DoubleType()),
    T.StructField("region", T.StringType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("raw_id", T.LongType()),
    RUN,
])

ETL_LOG = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("records_count", T.LongType()),
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("run_id", T.StringType()),
])

LEDGER = T.StructType([
    T.StructField("tender_no", T.StringType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("load_source", T.StringType()),
    T.StructField("loaded_at", T.TimestampType()),
    RUN,
])

SOURCE_REGISTRY = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("last_load_time", T.TimestampType()),
    T.StructField("last_load_count", T.LongType()),
    T.StructField("status", T.StringType()),
    # The two ends of what has been read: the newest item loaded, and the oldest one that a limit left unread.
    T.StructField("newest_item", T.DateType()),
    T.StructField("oldest_left", T.DateType()),
    T.StructField("left_count", T.LongType()),
])

FEED_ITEM = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("description", T.StringType()),
])

# Columns a search returns, in order.
RESULT_COLUMNS = ["tender_no", "organization", "description", "category",
                  "region", "budget", "status", "published_at"]

# Columns a user upload must bring.
REQUIRED_UPLOAD_COLUMNS = ["tender_no", "organization", "category", "region", "budget"]
