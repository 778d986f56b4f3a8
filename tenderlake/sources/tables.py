"""Catalog tables, views and ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def register(df: DataFrame, name: str) -> DataFrame:
    """Make the frame visible to SQL."""
    df.createOrReplaceTempView(name)
    return df


def run_sql(spark: SparkSession, query: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Ad-hoc SQL. Values go in as ``:name`` parameters, frames as ``{name}``."""
    return spark.sql(query, args=args, **frames)


def scan_table(spark: SparkSession, name: str, fallback: str, order: list[Column | str],
               limit: int | None = None) -> DataFrame:
    """A table, or the fallback table when it is missing or empty."""
    chosen = name
    if not spark.catalog.tableExists(name) or spark.table(name).isEmpty():
        chosen = fallback
    df = spark.table(chosen)
    return df if limit is None else df.orderBy(*order).limit(limit)


def count_table(spark: SparkSession, name: str, fallback: str) -> DataFrame:
    """One row ``count`` under the same fallback rule; 0 when both are missing."""
    for table in (name, fallback):
        if spark.catalog.tableExists(table) and not spark.table(table).isEmpty():
            return spark.table(table).agg(F.count(F.lit(1)).alias("count"))
    return spark.range(1).select(F.lit(0).cast("bigint").alias("count"))
