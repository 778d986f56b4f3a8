"""Repeated loads as streams over landed files.

State is bounded by the time of arrival; where memory of all earlier loads is
needed, stored tables hold it instead of operator state.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake import schema
from tenderlake.operators import dedup, layers
from tenderlake.operators.layout import cached
from tenderlake.sources import files

VERSION = ["tender_no", "content_hash"]


def landed_files(spark: SparkSession, folder: str, pattern: str, record: T.StructType,
                 files_per_batch: int | None = None) -> DataFrame:
    """Stream of the Parquet files landing in a folder."""
    reader = spark.readStream.schema(record).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def distinct_loads(stream: DataFrame, keys: list[str], delay: str = "1 day") -> DataFrame:
    """Drop repeats of the keys that arrive within the delay of the first.

    State is bounded by the time of arrival, not by dates inside the rows: a
    new tender is kept however old its date. Repeats after the delay come
    through; the ledger loader is for them.
    """
    arrived = stream.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", delay)
    return arrived.dropDuplicatesWithinWatermark(keys).drop("__arrived")


def window_counter(path: str, stream_id: str, time: str, group: str,
                   width: str = "1 hour") -> Callable[[DataFrame, int], None]:
    """Batch handler: loads per window and group of this batch, in a folder of its own.

    Nothing waits for a watermark: late rows are counted, the last windows
    too, and a repeated batch replaces its own counts.
    """

    def count(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy(F.window(time, width), group).agg(F.count(F.lit(1)).alias("loads"))
        counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), group,
                       "loads").write.mode("overwrite").parquet(f"{path}/run_id={stream_id}-{batch_id}")

    return count


def windowed_loads(spark: SparkSession, path: str, group: str) -> DataFrame:
    """Loads so far: (window_start, window_end, group, loads)."""
    return spark.read.parquet(path).groupBy("window_start", "window_end", group).agg(F.sum("loads").alias("loads"))


def promoted(raw_stream: DataFrame, clock: Column | datetime) -> DataFrame:
    """Raw rows as processed rows; the checkpoint remembers what is done."""
    return layers.enrich(raw_stream, clock)


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process everything available into Parquet and return the stored rows."""
    query = (stream.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def drain_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every micro-batch to ``handle`` until nothing is left."""
    query = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def ledger_loader(raw_path: str, ledger_path: str, source: str, clock: Column | datetime,
                  stream_id: str) -> Callable[[DataFrame, int], None]:
    """Batch handler: append unseen versions to the raw folder and the ledger.

    ``stream_id`` names the checkpoint: batch numbers start anew with each, so
    streams that share a raw folder need ids of their own. Each batch of a
    stream owns one folder in raw layer and ledger, so a repeated batch replaces its own
    output, and the ledger is derived from the rows that were written.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark, run_id = batch.sparkSession, f"{source}-{stream_id}-{batch_id}"
        # The batch's own entries of an interrupted run do not count as loaded.
        known = files.read_layer(spark, ledger_path, schema.LEDGER).where(F.col("run_id") != run_id)
        single = dedup.keep_first(layers.with_content_hash(batch), VERSION, ["published_at"])
        folder = f"{raw_path}/run_id={run_id}"
        with cached(single):
            # A batch is small beside the ledger: only the entries it asks for take part in the anti join.
            asked = known.join(single.select(VERSION), VERSION, "left_semi")
            fresh = layers.stamp(layers.not_loaded(single, asked), clock, source)
            fresh.write.mode("overwrite").parquet(folder)
        written = spark.read.schema(fresh.schema).parquet(folder)
        layers.ledger_rows(written, source, clock).write.mode("overwrite").parquet(f"{ledger_path}/run_id={run_id}")

    return load
