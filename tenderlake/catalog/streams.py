"""Structured Streaming loads over the landed test tables."""

from datetime import datetime

from pyspark.sql import functions as F

from tenderlake import schema
from tenderlake.catalog import fixtures as fx
from tenderlake.catalog.registry import DAY, SECOND, as_text, query
from tenderlake.session import scratch_path
from tenderlake.sources import files
from tenderlake.streaming import loads

CLOCK = datetime(2024, 2, 1, 12, 0)


def _stream(spark, sf_dir, name):
    return loads.landed_files(spark, sf_dir, f"{name}.parquet", fx.table(spark, sf_dir, name).schema)


def _tender_stream(spark, sf_dir):
    """Every tender arrives twice."""
    arrived = _stream(spark, sf_dir, "orders").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    rows = fx.tenders_from(arrived, spark, sf_dir)
    return rows.withColumn("published_at", F.col("published_at").cast("timestamp"))


@query("stream_distinct_loads", fx.over("tenders", body="""
    SELECT tender_no, category, strftime(published_at, '%Y-%m-%d') AS published_at FROM tenders"""))
def _(spark, sf_dir):
    root = scratch_path(spark, "stream")
    rows = loads.distinct_loads(_tender_stream(spark, sf_dir), ["tender_no"])
    stored = loads.drain(rows.select("tender_no", "category", "published_at"), f"{root}/out", f"{root}/state")
    return as_text(stored, published_at=DAY)


@query("stream_ledger_loads", fx.over("tenders", body="""
    SELECT 'raw' AS layer, category, count(*) AS n FROM tenders GROUP BY category
    UNION ALL SELECT 'ledger', '', count(*) FROM tenders
    UNION ALL SELECT 'second run', '', 0"""))
def _(spark, sf_dir):
    root = scratch_path(spark, "stream")
    # Two streams on one raw folder, of one feed: the second finds everything in the ledger.
    for stream_id in ("first", "second"):
        loads.drain_batches(_tender_stream(spark, sf_dir), loads.ledger_loader(
            f"{root}/raw", f"{root}/ledger", "feed", CLOCK, stream_id), f"{root}/{stream_id}")
    raw = files.read_layer(spark, f"{root}/raw", schema.RAW_LAYER)
    entries = files.read_layer(spark, f"{root}/ledger", schema.LEDGER)
    counted = raw.groupBy("category").agg(F.count(F.lit(1)).alias("n")).select(F.lit("raw").alias("layer"), "category", "n")
    for name, rows in (("ledger", entries), ("second run", raw.where(F.startswith("run_id", F.lit("feed-second-"))))):
        counted = counted.unionByName(rows.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("layer"), F.lit("").alias("category"), "n"))
    return counted


@query("stream_promote", fx.over("tenders", body="""
    SELECT tender_no, category, CAST(month(published_at) AS integer) AS month,
           CAST(quarter(published_at) AS integer) AS quarter, id AS raw_id, '2024-02-01' AS processed_at FROM tenders"""))
def _(spark, sf_dir):
    root = scratch_path(spark, "stream")
    raw = fx.tenders_from(_stream(spark, sf_dir, "orders"), spark, sf_dir)
    stored = loads.drain(loads.promoted(raw, CLOCK), f"{root}/out", f"{root}/state")
    return as_text(stored.select("tender_no", "category", "month", "quarter", "raw_id", "processed_at"),
                   processed_at=DAY)


@query("stream_windowed_loads", """
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
           event_type, count(*) AS loads
    FROM (SELECT date_trunc('hour', ts) AS w, event_type FROM events) e GROUP BY w, event_type""")
def _(spark, sf_dir):
    root = scratch_path(spark, "stream")
    events = _stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    loads.drain_batches(events, loads.window_counter(f"{root}/out", "events", "ts", "event_type"), f"{root}/state")
    return as_text(loads.windowed_loads(spark, f"{root}/out", "event_type"), window_start=SECOND, window_end=SECOND)
