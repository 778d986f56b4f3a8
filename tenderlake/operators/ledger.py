"""A load ledger in buckets, looked up without moving it.

The ledger is an external table clustered by the version of a tender (number
and content hash). A batch is brought to the buckets of the ledger, never the
ledger to the batch; for few versions only their buckets are read. Entries are
added by appending files, and read again from any session by their path.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.operators import layers

#: Columns of the ledger.
COLUMNS = "version string, tender_no string, content_hash string, load_source string, loaded_at timestamp, run_id string"
#: Versions up to this number are looked up in their own buckets only.
FEW = 500


def version() -> Column:
    """Number and content as one value; a row without either has none."""
    return F.concat(F.col("tender_no"), F.lit(":"), F.col("content_hash"))


def open_ledger(spark: SparkSession, name: str, path: str, buckets: int = 64) -> DataFrame:
    """The ledger at a path as catalog table ``name``; an empty one where nothing is stored yet.

    ``buckets`` belongs to the files: a ledger is opened with the number it was made with.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet CLUSTERED BY (version) SORTED BY (version) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def enter(loaded: DataFrame, name: str, source: str, clock: Column | datetime, run_id: str, buckets: int = 64) -> None:
    """Add the versions of loaded rows (tender_no, content_hash): at most one file a bucket."""
    rows = layers.ledger_rows(loaded, source, clock).withColumns({"version": version(), "run_id": F.lit(run_id)})
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    rows.where("version IS NOT NULL").select(names).dropDuplicates(["version"]).repartition(buckets, "version") \
        .write.insertInto(name)


def known(batch: DataFrame, ledger: DataFrame, few: int = FEW) -> DataFrame:
    """The entries of the batch's versions (tender_no, content_hash), each version once.

    Up to ``few`` versions become a list of values that prunes buckets; more of
    them are shuffled to the buckets, or broadcast if Spark finds them small.
    """
    asked = batch.select(version().alias("version")).where("version IS NOT NULL").distinct()
    first = [r["version"] for r in asked.limit(few + 1).collect()]
    entries = ledger.where(F.col("version").isin(first)) if len(first) <= few else ledger.join(asked, "version", "left_semi")
    return entries.groupBy("version").agg(F.min("tender_no").alias("tender_no"), F.min("content_hash").alias("content_hash"))


def new_rows(batch: DataFrame, ledger: DataFrame, few: int = FEW) -> DataFrame:
    """Rows of the batch whose version the ledger does not have."""
    found = known(batch, ledger, few).select("version")
    return batch.withColumn("version", version()).join(found, "version", "left_anti").drop("version")
