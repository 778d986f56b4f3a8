"""Time series of tenders and load monitoring."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import numbers
from tenderlake.operators import filters


def daily_sum(df: DataFrame, by: str | None = None, time: str = "published_at", value: str = "budget") -> DataFrame:
    """Budget per day, optionally per day and dimension."""
    groups = [F.to_date(time).alias("day")] + ([F.col(by)] if by else [])
    return df.groupBy(*groups).agg(F.sum(value).alias("total_budget")).orderBy("day", *([by] if by else []))


def daily_count(df: DataFrame, time: str = "published_at") -> DataFrame:
    return df.groupBy(F.to_date(time).alias("day")).agg(F.count(F.lit(1)).alias("count")).orderBy("day")


def trend_summary(df: DataFrame, time: str = "published_at", value: str = "budget") -> DataFrame:
    """Number of days, extremes of the daily sums and change from first to last day in percent."""
    daily = df.groupBy(F.to_date(time).alias("day")).agg(F.sum(value).alias("v"))
    first, last = F.min_by("v", "day"), F.max_by("v", "day")
    return daily.agg(
        F.count(F.lit(1)).alias("periods"), F.max("v").alias("max_total"), F.min("v").alias("min_total"),
        F.when(F.count(F.lit(1)) > 1, F.try_divide((last - first) * F.lit(100.0), first))
        .otherwise(F.lit(0.0)).alias("change_pct"))


def hourly_loads(df: DataFrame, time: str = "logged_at", hours: int = 24,
                 anchor: Column | datetime | None = None) -> DataFrame:
    """Loads per (day, hour) of the last hours, newest first."""
    recent = filters.loaded_within(df, time, hours, anchor)
    return (recent.groupBy(F.to_date(time).alias("day"), F.hour(time).alias("hour"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("day"), F.desc("hour")))


def loads_per_day(df: DataFrame, time: str = "logged_at") -> DataFrame:
    return daily_count(df, time)


def log_success(df: DataFrame, status: str = "status") -> DataFrame:
    """Successful and failed log rows and the success share; the case of the word is ignored."""
    good = F.count_if(F.lower(status) == "success")
    bad = F.count_if(F.lower(status) == "error")
    return df.agg(F.count(F.lit(1)).alias("total"), good.alias("success_count"), bad.alias("error_count")) \
        .withColumn("success_pct", numbers.percent_of("success_count", "total"))


def last_loads(df: DataFrame, group: str, time: str) -> DataFrame:
    """Newest load per group, newest first."""
    return df.groupBy(group).agg(F.max(time).alias("last_load_time")).orderBy(F.desc("last_load_time"), group)


def rolling_load_stats(df: DataFrame, time: str = "logged_at", hours: int = 1,
                       anchor: Column | datetime | None = None) -> DataFrame:
    """Per source: all loads, loads of the last hours and the newest load; one pass."""
    point = filters.newest(df, time) if anchor is None else (anchor if isinstance(anchor, Column) else F.lit(anchor))
    recent = F.col(time) > point - F.make_dt_interval(hours=F.lit(hours))
    return (df.select("source", time, recent.alias("__recent"))
            .groupBy("source").agg(F.count(F.lit(1)).alias("total_loads"),
                                   F.count_if("__recent").alias("recent_loads"),
                                   F.max(time).alias("last_load_time")).orderBy("source"))


def load_counts(df: DataFrame, keys: list[str], time: str, hours: int = 24,
                anchor: Column | datetime | None = None) -> DataFrame:
    """Loads of the last hours and, apart from them, how many repeated an earlier key."""
    per_key = filters.loaded_within(df, time, hours, anchor).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("loads"),
                       F.coalesce(F.sum(F.col("n") - F.lit(1)), F.lit(0)).alias("repeats"))


def log_lines(lines: DataFrame, level: str | None = None, last: int = 50, column: str = "value") -> DataFrame:
    """The newest lines of a text log, optionally of one level: (logged_at, level, line)."""
    stamp = F.regexp_extract(column, r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})", 1)
    found = F.regexp_extract(column, r"\b(INFO|WARNING|ERROR|DEBUG)\b", 1)
    parsed = lines.select(stamp.alias("logged_at"), found.alias("level"), F.col(column).alias("line"))
    if level:
        parsed = parsed.where(F.col("level") == level)
    return parsed.orderBy(F.desc("logged_at"), F.desc("line")).limit(last)
