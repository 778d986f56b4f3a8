"""De-duplication. Copies collapse map-side before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the first in the given ascending order.

    A minimum over (order, row) is a mergeable aggregate, so a key with very
    many copies reaches the shuffle as one row per input partition. Rows that
    tie on the order are settled by their contents.
    """
    return _extreme(df, keys, order, F.min)


def keep_last(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the last in the given ascending order."""
    return _extreme(df, keys, order, F.max)


def _extreme(df, keys, order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    ranks = [(F.col(o) if isinstance(o, str) else o).alias(f"__o{i}") for i, o in enumerate(order)]
    best = df.groupBy(*keys).agg(pick(F.struct(*ranks, *rest)).alias("__row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows before and after de-duplication on the keys, and removed."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("initial_count"),
                      F.count(F.lit(1)).alias("final_count")) \
        .withColumn("removed", F.col("initial_count") - F.col("final_count"))
