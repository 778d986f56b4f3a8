"""Keyword and faceted search, facet lists and result statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import numbers, text
from tenderlake.operators.filters import ALL
from tenderlake.schema import RESULT_COLUMNS

SEARCHED = ["tender_no", "organization", "description", "category", "region"]
MIN_QUERY = 2


def too_short(query: str | None) -> bool:
    return query is None or len(query.strip()) < MIN_QUERY


def any_column_contains(query: str, columns: list[str] = SEARCHED) -> Column:
    """Literal, case-insensitive substring in at least one column."""
    return reduce(lambda a, b: a | b, [F.coalesce(text.contains_any_case(c, query), F.lit(False)) for c in columns])


def relevance(query: str, key: str = "tender_no", name: str = "organization") -> Column:
    """1 key equals, 2 name equals, 3 key starts, 4 name starts, 5 elsewhere."""
    wanted = F.lower(F.lit(query))
    key, name = F.lower(F.col(key)), F.lower(F.col(name))
    return (F.when(key == wanted, F.lit(1)).when(name == wanted, F.lit(2))
            .when(F.startswith(key, wanted), F.lit(3)).when(F.startswith(name, wanted), F.lit(4))
            .otherwise(F.lit(5)))


def full_search(df: DataFrame, query: str, limit: int = 100, columns: list[str] = SEARCHED,
                key: str = "tender_no", name: str = "organization",
                result: list[str] = RESULT_COLUMNS) -> DataFrame:
    """Keyword search over several columns, best match first, then shortest key."""
    if too_short(query):
        return df.select(*result).limit(0)
    hits = df.filter(any_column_contains(query, columns))
    return (hits.withColumn("__rank", relevance(query, key, name))
            .orderBy(F.asc("__rank"), F.length(key).asc(), F.asc(key)).limit(limit)
            .select(*result))


def combined_search(df: DataFrame, query: str = "", category: str | None = None, region: str | None = None,
                    min_budget: float | None = None, max_budget: float | None = None,
                    organization: str | None = None, status: str | None = None, limit: int = 100) -> DataFrame:
    """Faceted search: the first ``limit`` hits by id."""
    return all_hits(df, query, category, region, min_budget, max_budget, organization, status) \
        .orderBy("id").limit(limit).select(*RESULT_COLUMNS)


def all_hits(df: DataFrame, query: str = "", category: str | None = None, region: str | None = None,
             min_budget: float | None = None, max_budget: float | None = None,
             organization: str | None = None, status: str | None = None) -> DataFrame:
    """Every hit of a faceted search: each given filter narrows the result."""
    hits = df
    if not too_short(query):
        hits = hits.filter(any_column_contains(query))
    for column, value in (("category", category), ("region", region), ("status", status)):
        if value and value != ALL:
            hits = hits.filter(text.equals_any_case(column, value))
    if organization:
        hits = hits.filter(text.contains_any_case("organization", organization))
    if min_budget is not None and min_budget >= 0:
        hits = hits.filter(F.col("budget") >= F.lit(min_budget))
    if max_budget is not None and max_budget >= 0:
        hits = hits.filter(F.col("budget") <= F.lit(max_budget))
    return hits


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-empty values of a facet, sorted."""
    return (df.filter(F.col(column).isNotNull() & (F.col(column) != "")).select(column).distinct().orderBy(column))


def budget_range(df: DataFrame) -> DataFrame:
    """Smallest and largest positive budget; (0, 1,000,000) without one."""
    return df.filter(F.col("budget").isNotNull() & (F.col("budget") > 0)).agg(
        F.coalesce(F.min("budget"), F.lit(0.0)).alias("min_budget"),
        F.coalesce(F.max("budget"), F.lit(1_000_000.0)).alias("max_budget"))


def total_stats(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Counts, distinct counts and budget statistics of the rows with a budget.

    ``approximate`` replaces the exact distinct counts, which shuffle every
    value once, by mergeable sketches.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    money = [F.coalesce(fn("budget"), F.lit(0.0)).alias(name) for fn, name in
             ((F.avg, "avg_budget"), (F.sum, "total_budget"), (F.min, "min_budget"), (F.max, "max_budget"))]
    return df.filter(F.col("budget").isNotNull()).agg(
        F.count(F.lit(1)).alias("total_count"),
        distinct("category").alias("categories_count"),
        distinct("region").alias("regions_count"),
        distinct("organization").alias("organizations_count"),
        distinct("status").alias("statuses_count"),
        *money)


def results_stats(df: DataFrame, budget: str = "budget") -> DataFrame:
    """Statistics of a result set; a budget that is no number counts as missing."""
    value = numbers.as_double(budget)
    money = [F.coalesce(fn(value), F.lit(0.0)).alias(name) for fn, name in
             ((F.avg, "avg_budget"), (F.sum, "total_budget"), (F.min, "min_budget"), (F.max, "max_budget"))]
    return df.agg(F.count(F.lit(1)).alias("count"), *money,
                  F.count_distinct("category").alias("categories"),
                  F.count_distinct("region").alias("regions"))
