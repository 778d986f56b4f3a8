"""Grouped and global aggregations, top-k reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STATS = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min}


def totals_by(df: DataFrame, group: str, value: str = "budget", key: str = "id") -> DataFrame:
    """Sum of a value and count of a key per group. A missing column is an error."""
    missing = [c for c in (group, value, key) if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.groupBy(group).agg(F.sum(value).alias("total_budget"), F.count(key).alias("count"))


def stats_by(df: DataFrame, groups: list[str], value: str, stats: list[str], suffix: str) -> DataFrame:
    """Count and the listed statistics per group, columns ``<stat>_<suffix>``."""
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("count"),
        *[_STATS[s](value).alias(f"{_name(s)}_{suffix}") for s in stats])


def by_dimensions(df: DataFrame, value: str = "sum_value") -> DataFrame:
    """Category x region: count, total, mean, largest and smallest value; largest total first."""
    grouped = stats_by(df, ["category", "region"], value, ["sum", "avg", "max", "min"], "value")
    return grouped.orderBy(F.desc("total_value"), "category", "region")


def category_summary(df: DataFrame) -> DataFrame:
    """Count, mean, largest and smallest budget per category."""
    return stats_by(df, ["category"], "budget", ["avg", "max", "min"], "budget")


def category_totals(df: DataFrame) -> DataFrame:
    """Count and all budget statistics per category, largest total first."""
    grouped = stats_by(df, ["category"], "budget", ["sum", "avg", "max", "min"], "budget")
    return grouped.orderBy(F.desc("total_budget"), "category")


def region_totals(df: DataFrame) -> DataFrame:
    """Count, total and mean budget per region, largest total first."""
    grouped = stats_by(df, ["region"], "budget", ["sum", "avg"], "budget")
    return grouped.orderBy(F.desc("total_budget"), "region")


def overall_totals(df: DataFrame) -> DataFrame:
    return df.agg(F.sum("budget").alias("total_budget"), F.avg("budget").alias("avg_budget"),
                  F.max("budget").alias("max_budget"), F.min("budget").alias("min_budget"),
                  F.count(F.lit(1)).alias("count"))


def column_profile(df: DataFrame, column: str) -> DataFrame:
    """Row and column count of the frame and count, mean, min, max of one column."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).cast("bigint").alias("column_count"),
                  F.count(column).alias("count"), F.avg(column).alias("avg"),
                  F.min(column).alias("min"), F.max(column).alias("max"))


def average_by(df: DataFrame, group: str, value: str = "budget") -> DataFrame:
    """Mean per group, highest first."""
    return df.groupBy(group).agg(F.avg(value).alias("avg_budget")).orderBy(F.desc("avg_budget"), group)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULLs are not counted."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), column))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"{c}_count") for c in columns])


def top_groups_by_count(df: DataFrame, group: str, k: int = 5) -> DataFrame:
    return value_counts(df, group).limit(k)


def top_groups_by_sum(df: DataFrame, group: str, value: str = "budget", k: int = 10) -> DataFrame:
    return (df.groupBy(group).agg(F.sum(value).alias("total_budget"))
            .orderBy(F.desc("total_budget"), group).limit(k))


def first_rows(df: DataFrame, n: int, order: list[Column | str]) -> DataFrame:
    """A preview: the first n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def histogram(df: DataFrame, column: str = "budget", bins: int = 50) -> DataFrame:
    """Equal-width bins between the extremes: (bin, low, high, count), empty bins left out.

    The upper edge belongs to the last bin; a constant column fills bin 1.
    """
    edges = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high")).alias("edges")).scalar()
    placed = df.where(F.col(column).isNotNull()).select(F.col(column).alias("v"), edges.alias("e"))
    low, high = F.col("e.low"), F.col("e.high")
    number = F.least(F.when(high > low, F.floor((F.col("v") - low) * F.lit(bins) / (high - low))).otherwise(0)
                     + F.lit(1), F.lit(bins)).cast("int")
    width = (high - low) / F.lit(bins)
    counted = placed.select(number.alias("bin"), low.alias("lo"), width.alias("width")) \
        .groupBy("bin", "lo", "width").agg(F.count(F.lit(1)).alias("count"))
    return counted.select("bin", (F.col("lo") + (F.col("bin") - 1) * F.col("width")).alias("low"),
                          (F.col("lo") + F.col("bin") * F.col("width")).alias("high"), "count")


def _name(stat: str) -> str:
    return "total" if stat == "sum" else stat
