"""Row filters. All are plain predicates, so simple ones reach the scan."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import dates, text

# Fixed value: the choice that means "no filter".
ALL = "Все"


def where_values(df: DataFrame, filters: dict) -> DataFrame:
    """Rows whose columns have one of the wanted values, a single one or a list; unknown columns are ignored."""
    wanted = {c: v if isinstance(v, (list, tuple)) else [v] for c, v in filters.items() if c in df.columns}
    tests = [F.col(c).isin(list(v)) if len(v) != 1 else F.col(c) == F.lit(v[0]) for c, v in wanted.items()]
    return df.where(reduce(Column.__and__, tests, F.lit(True)))


def above_budget(df: DataFrame, bound: float, columns: list[str], budget: str = "budget", tie: str = "id") -> DataFrame:
    """Rows above the bound, projected, most expensive first."""
    return (df.filter(F.col(budget) > F.lit(bound)).orderBy(F.desc(budget), F.asc(tie)).select(*columns))


def by_category(df: DataFrame, category: str, limit: int = 100) -> DataFrame:
    return _dearest(df.filter(text.equals_any_case("category", category)), limit)


def by_region(df: DataFrame, region: str, limit: int = 100) -> DataFrame:
    return _dearest(df.filter(text.equals_any_case("region", region)), limit)


def by_budget(df: DataFrame, low: float, high: float, limit: int = 100) -> DataFrame:
    return _dearest(df.filter(F.col("budget").between(low, high)), limit)


def by_organization(df: DataFrame, name: str, limit: int = 100) -> DataFrame:
    return _dearest(df.filter(text.contains_any_case("organization", name)), limit)


def _dearest(df: DataFrame, limit: int) -> DataFrame:
    return df.orderBy(F.desc("budget"), F.asc("id")).limit(limit)


def matches_selection(df: DataFrame, category: str, region: str, status: str, low: float, high: float) -> DataFrame:
    """Exact category, region and status within a closed budget range."""
    return df.filter((F.col("category") == category) & (F.col("region") == region) & (F.col("status") == status)
                     & F.col("budget").between(low, high))


def in_selections(df: DataFrame, categories: list[str] | DataFrame, regions: list[str] | DataFrame) -> DataFrame:
    """Multi-select on category and region: lists, or one-column tables of any size."""
    return _selected(_selected(df, "category", categories), "region", regions)


def _selected(df: DataFrame, column: str, wanted: list[str] | DataFrame) -> DataFrame:
    if not isinstance(wanted, DataFrame):
        return df.filter(F.col(column).isin(list(wanted)))
    return df.join(wanted.toDF(column), column, "left_semi")


def with_positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) > 0))


def newest(df: DataFrame, column: str) -> Column:
    """The newest time in a column as a scalar sub-query, to anchor recency."""
    return df.agg(F.max(column).alias("anchor")).scalar()


def loaded_within(df: DataFrame, column: str, hours: int, anchor: Column | datetime | None = None) -> DataFrame:
    """Rows of the last ``hours`` before the anchor (default: the newest row)."""
    return df.filter(dates.within_hours(column, _anchor(df, column, anchor), hours))


def retained(df: DataFrame, column: str, days: int = 7, anchor: Column | datetime | None = None) -> DataFrame:
    """Ledger retention: rows not older than ``days`` before the anchor."""
    return df.filter(dates.within_days(column, _anchor(df, column, anchor), days))


def newer_than(df: DataFrame, column: str, mark: Column | datetime | date | None) -> DataFrame:
    """Rows after the high-water mark; rows without a date are kept."""
    if mark is None:
        return df
    mark = mark if isinstance(mark, Column) else F.lit(mark)
    return df.filter(F.col(column).isNull() | mark.isNull() | (F.col(column) > mark))


def _anchor(df, column, anchor) -> Column:
    if anchor is None:
        return newest(df, column)
    return anchor if isinstance(anchor, Column) else F.lit(anchor)
