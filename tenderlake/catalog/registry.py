"""Name -> query and name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL counterpart where SQL can express it."""

    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def rounded(df: DataFrame, digits: int = 2) -> DataFrame:
    """Round every double column, as its SQL counterpart does."""
    doubles = [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else df


def as_text(df: DataFrame, **forms: str) -> DataFrame:
    """Print date and time columns in the given forms."""
    return df.withColumns({c: F.date_format(c, form) for c, form in forms.items()})


DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"
