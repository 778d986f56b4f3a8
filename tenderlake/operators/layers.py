"""Raw -> processed promotion, duplicate look-ups, insert-or-ignore, registry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import dates, numbers, text
from tenderlake.operators.dedup import keep_first, keep_last

PROCESSED_COLUMNS = ["tender_no", "category", "budget", "budget_mln", "region",
                     "month", "quarter", "processed_at", "raw_id"]


def existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns the frame has, in the wanted order."""
    return df.select([c for c in wanted if c in df.columns])


def stamp(df: DataFrame, clock: Column | datetime, source: str, column: str = "load_source") -> DataFrame:
    """Audit columns of a raw-layer row."""
    return df.withColumns({"loaded_at": _clock(clock), column: F.lit(source)})


def unprocessed(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Raw rows without a processed row. A NULL ``raw_id`` refers to nothing."""
    # Distinct first: repeated references collapse before the shuffle.
    done = processed.where(F.col("raw_id").isNotNull()).select("raw_id").distinct()
    return raw.join(done, raw["id"] == done["raw_id"], "left_anti")


def enrich(raw: DataFrame, clock: Column | datetime) -> DataFrame:
    """Processed-layer columns of raw rows; an unparsable date gives no month."""
    kind = dict(raw.dtypes).get("published_at")
    when = dates.as_timestamp("published_at") if kind == "string" else F.col("published_at")
    rich = raw.withColumns({
        "month": F.month(when), "quarter": F.quarter(when), "budget_mln": numbers.millions("budget"),
        "processed_at": _clock(clock), "raw_id": F.col("id")})
    return existing(rich, PROCESSED_COLUMNS)


def promote(raw: DataFrame, processed: DataFrame, clock: Column | datetime) -> DataFrame:
    """New processed rows: enrichment of what is not processed yet."""
    return enrich(unprocessed(raw, processed), clock)


def lineage(processed: DataFrame, raw: DataFrame) -> DataFrame:
    """Processed rows with the organization and source of their raw row."""
    origin = raw.select(F.col("id").alias("raw_id"), "organization", "source")
    return processed.join(origin, "raw_id")


def with_content_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("content_hash", text.content_hash("tender_no", "description", "budget"))


def not_loaded(batch: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose (number, content) the ledger does not have.

    The same number with other content is a new version and passes.
    """
    return batch.join(_ledger_keys(ledger), ["tender_no", "content_hash"], "left_anti")


def already_loaded(batch: DataFrame, ledger: DataFrame) -> DataFrame:
    return batch.join(_ledger_keys(ledger), ["tender_no", "content_hash"], "left_semi")


def load_outcome(batch: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: new, duplicate and faulty rows of a batch against the ledger.

    Copies inside the batch collapse first; every copy but one is a duplicate,
    and a row without a number is an error.
    """
    keyed = batch.select("tender_no", "content_hash").groupBy("tender_no", "content_hash") \
        .agg(F.count(F.lit(1)).alias("n"))
    known = _ledger_keys(ledger).withColumn("known", F.lit(True))
    matched = keyed.join(known, ["tender_no", "content_hash"], "left")
    faulty = F.col("tender_no").isNull()
    fresh = F.col("known").isNull() & ~faulty
    return matched.agg(
        F.coalesce(F.count_if(fresh), F.lit(0)).alias("loaded_count"),
        F.coalesce(F.sum(F.when(~faulty, F.col("n") - F.when(fresh, F.lit(1)).otherwise(F.lit(0)))), F.lit(0))
        .alias("duplicate_count"),
        F.coalesce(F.sum(F.when(faulty, F.col("n"))), F.lit(0)).alias("error_count"))


def ledger_rows(loaded: DataFrame, source: str, clock: Column | datetime) -> DataFrame:
    """Ledger entries derived from rows that were written."""
    return loaded.select("tender_no", "content_hash").withColumns(
        {"load_source": F.lit(source), "loaded_at": _clock(clock)})


def insert_or_ignore(batch: DataFrame, target: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """Rows of the batch to append: first per key, keys of the target left out."""
    first = keep_first(batch.where(F.col(key).isNotNull()), [key], order)
    return first.join(target.select(key).distinct(), key, "left_anti")


def processing_stats(processed: DataFrame) -> DataFrame:
    """(dimension, value, count, total_budget) by category, region and month in one pass."""
    dims = ["category", "region", "month"]
    entries = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims])
    return (processed.select(F.explode(entries).alias("e"), "budget_mln")
            .groupBy("e.dimension", "e.value")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("budget_mln").alias("total_budget")))


def stats_of(processed: DataFrame, dimension: str) -> DataFrame:
    """Count and budget in millions per value: months in order, others largest first."""
    grouped = processed.groupBy(dimension).agg(F.count(F.lit(1)).alias("count"),
                                               F.sum("budget_mln").alias("total_budget"))
    return grouped.orderBy("month") if dimension == "month" else grouped.orderBy(F.desc("total_budget"), dimension)


def layer_counts(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """One row: rows of both layers and the processed share in percent (NULL without raw rows)."""
    count = F.count(F.lit(1)).alias("n")
    return (raw.agg(count).select(F.col("n").alias("raw_count"), processed.agg(count).scalar().alias("processed_count"))
            .withColumn("processed_pct", numbers.percent_of("processed_count", "raw_count")))


def latest(df: DataFrame, time: str, key: str, limit: int = 100) -> DataFrame:
    """The newest rows of a layer or log."""
    return df.orderBy(F.desc(time), F.asc(key)).limit(limit)


def upsert_sources(registry: DataFrame, updates: DataFrame) -> DataFrame:
    """Registry with the newest row per source; unknown sources are registered."""
    both = registry.unionByName(updates, allowMissingColumns=True)
    return keep_last(both, ["name"], ["last_load_time"])


def source_stats(registry: DataFrame) -> DataFrame:
    return existing(registry, ["name", "kind", "last_load_time", "last_load_count", "status"]) \
        .orderBy(F.desc("last_load_time"), "name")


def _ledger_keys(ledger: DataFrame) -> DataFrame:
    return ledger.select("tender_no", "content_hash").distinct()


def _clock(clock) -> Column:
    return clock if isinstance(clock, Column) else F.lit(clock)
