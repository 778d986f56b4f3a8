"""Physical layout: partitioning, caching, sizes, run facts."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread_rows(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin repartition, by default to twice the parallelism."""
    if partitions is None:
        partitions = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(partitions)


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows of each partition, empty ones included."""
    filled = df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
    every = df.sparkSession.range(df.rdd.getNumPartitions()).select(F.col("id").cast("int").alias("partition"))
    return every.join(filled, "partition", "left").select("partition", F.coalesce("rows", F.lit(0)).alias("rows"))


def partition_summary(df: DataFrame) -> DataFrame:
    """One row: rows, partitions, mean per partition and skew (largest / mean)."""
    return (partition_rows(df).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_records"), F.count(F.lit(1)).alias("num_partitions"),
        F.coalesce(F.avg("rows"), F.lit(0.0)).alias("avg_per_partition"), F.max("rows").alias("largest"))
        .select("total_records", "num_partitions", "avg_per_partition",
                F.try_divide("largest", "avg_per_partition").alias("skew")))


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep a frame while it is used more than once."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """One row: files and bytes of a stored dataset, from the listing alone."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listing.select("length").agg(F.count(F.lit(1)).alias("files"),
                                        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def dataset_size(df: DataFrame) -> DataFrame:
    """One row: files, bytes and rows of a table read from files, those without a row left out."""
    each = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return each.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
                    F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


#: Settings a run is described by.
FACTS = ["spark.app.name", "spark.master", "spark.executor.memory", "spark.default.parallelism",
         "spark.sql.shuffle.partitions"]


def run_facts(spark: SparkSession, settings: list[str] = FACTS) -> DataFrame:
    """(fact, value): version and settings of the running session; NULL where one is not set."""
    pairs = [F.struct(F.lit(name).alias("fact"), F.lit(spark.conf.get(name, None)).cast("string").alias("value"))
             for name in settings]
    pairs.append(F.struct(F.lit("spark.version").alias("fact"), F.version().alias("value")))
    return spark.range(1).select(F.inline(F.array(*pairs)))
