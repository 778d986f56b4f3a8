"""Trend report over a selection of categories and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tenderlake.operators import filters, trends


def report(tenders: DataFrame, categories: list[str] | DataFrame, regions: list[str] | DataFrame) -> dict[str, DataFrame]:
    chosen = filters.in_selections(tenders, categories, regions)
    return {
        "daily_budget": trends.daily_sum(chosen),
        "daily_count": trends.daily_count(chosen),
        "by_category": trends.daily_sum(chosen, "category"),
        "by_region": trends.daily_sum(chosen, "region"),
        "summary": trends.trend_summary(chosen),
    }
