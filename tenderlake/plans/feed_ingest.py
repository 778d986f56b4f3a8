"""Feed ingest: items -> records -> new versions -> raw -> processed."""

from __future__ import annotations

import hashlib
from datetime import date, datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tenderlake import schema, sinks
from tenderlake.functions import dates
from tenderlake.operators import dedup, layers
from tenderlake.session import folders, scratch_tables, stored
from tenderlake.sources import feed, files

#: The hash stands first, as sorts tell rows apart by the first bytes of the first key.
VERSION = ["content_hash", "tender_no"]
#: What copies of a version may differ in.
FIELDS = ["title", "link", "published", "description"]


def single_versions(items: DataFrame) -> DataFrame:
    """One item of each version: the oldest, then the first by link."""
    return dedup.keep_first(items, VERSION, [feed.day(items), "link"])


def new_records(items: DataFrame, ledger: DataFrame, source: str, clock, limit: int | None = None) -> DataFrame:
    """Records of the items that the ledger does not know, one per version; ``limit`` takes the newest of them.

    Only number, title and price are read from every item; the other fields
    are taken from the items that turn out to be new.
    """
    fresh = single_versions(layers.not_loaded(feed.feed_versions(items), ledger))
    fresh = fresh if limit is None else feed.newest(fresh, limit)
    return feed.feed_records(fresh, source, clock, keep=("content_hash",))


def numbered(items: DataFrame) -> DataFrame:
    """Items to be stored, with a row number and two hashes of the fields in which copies of a version may differ."""
    # Hashing passes over missing values, so which are missing is hashed, too.
    told = [*FIELDS, *[F.col(c).isNull() for c in FIELDS]]
    return items.withColumns({"__row": F.monotonically_increasing_id(), "__h0": F.xxhash64(F.lit(0), *told), "__h1": F.xxhash64(F.lit(1), *told)})


def counted_versions(items: DataFrame) -> DataFrame:
    """(version, n, row, alike): items of each version, the first row of them, and whether all are copies of it.

    Numbers only, so versions are met in hash tables and no text is sorted.
    """
    ends = [f(c) for c in ("__h0", "__h1") for f in (F.min, F.max)]
    return items.groupBy(*VERSION).agg(F.count(F.lit(1)).alias("n"), F.min("__row").alias("row"),
                                       ((ends[0] == ends[1]) & (ends[2] == ends[3])).alias("alike"))


def first_items(items: DataFrame, fresh: DataFrame, mixed: bool) -> DataFrame:
    """One item of each version of ``fresh``, as ``single_versions`` takes them.

    Only if there are ``mixed`` versions, whose items are not all alike, these items are put in order.
    """
    rows = fresh.where("alike").select(F.col("row").alias("__row"))
    if mixed:
        rows = rows.unionByName(single_versions(items.join(fresh.where("NOT alike"), VERSION, "left_semi")).select("__row"))
    return items.join(rows, "__row", "left_semi")


def open_runs(done: DataFrame, loaded: DataFrame) -> list[str]:
    """Runs of ``loaded`` that ``done`` has no folder of. Only the partition column is read; open runs are few."""
    runs = loaded.select("run_id").distinct().join(done.select("run_id").distinct(), "run_id", "left_anti")
    return sorted(r["run_id"] for r in runs.collect())


def known_versions(ledger: DataFrame, raw: DataFrame) -> DataFrame:
    """Loaded versions: the ledger, and raw loads that stopped before their ledger entries."""
    stopped = layers.with_content_hash(raw.where(F.col("run_id").isin(open_runs(ledger, raw))))
    return ledger.select(VERSION).unionByName(stopped.select(VERSION))


def waiting_runs(spark: SparkSession, done_path: str, loaded_path: str) -> list[str]:
    """Runs written to one layer and not to the other, by the names of their folders alone."""
    return sorted(set(folders(spark, loaded_path, "run_id")) - set(folders(spark, done_path, "run_id")))


def asked_versions(asked: DataFrame, ledger: DataFrame, raw: DataFrame, stopped: list[str]) -> DataFrame:
    """The ``asked`` versions that are loaded: by the ledger, or by raw loads that stopped before their entries.

    The ledger is a stream past the asked versions, which Spark broadcasts if
    they are few; nothing of it is shuffled or written then.
    """
    late = layers.with_content_hash(raw.where(F.col("run_id").isin(stopped)))
    return ledger.select(VERSION).unionByName(late.select(VERSION)).join(asked, VERSION, "left_semi").distinct()


def run(spark: SparkSession, feed_path: str, lake: str, source: str, clock: datetime, run_id: str,
        limit: int | None = None, since: date | None = None) -> dict[str, int]:
    """One load of landed feed files into the lake; returns loaded, duplicate, error and processed rows.

    The raw rows are written first and the ledger is derived from them. A load
    that stopped half-way can be repeated under its ``run_id``; another load
    sees its raw rows as loaded and processes them. ``limit`` takes the newest
    unknown items; the day of the oldest one left goes to the registry.
    ``since`` is a high-water mark, such as ``last_load`` gives: items dated
    before it are not looked at, those without a date are. Malformed items are
    counted.
    """
    lake = lake.rstrip("/")
    paths = {name: f"{lake}/{name}" for name in ("raw", "processed", "ledger", "log")}
    others = F.col("run_id") != F.lit(run_id)

    def layer(name, record):
        return files.read_layer(spark, paths[name], record)

    with scratch_tables(spark):
        items = feed.feed_versions(feed.read_feed(spark, feed_path), carry=True).drop("__text")
        items = numbered(items if since is None else items.withColumn("__day", dates.feed_date("published")))
        items = stored(items, "feed-items")
        if since is not None:
            # Behind the stored rows: before them, Spark would parse each item again for each field the condition names.
            items = items.where(F.col("faulty").isNotNull() | F.col("__day").isNull() | (F.col("__day") >= F.lit(since)))
        sound = items.where("faulty IS NULL").drop("faulty")
        asked = stored(counted_versions(sound), "feed-asked")
        stopped = [r for r in waiting_runs(spark, paths["ledger"], paths["raw"]) if r != run_id]
        known = asked_versions(asked.select(VERSION), layer("ledger", schema.LEDGER).where(others),
                               layer("raw", schema.RAW_LAYER).where(others), stopped)
        fresh = stored(layers.not_loaded(asked, known), "feed-fresh")
        found = fresh.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("alike")).alias("mixed")).first()
        seen = asked.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        faulty = items.where("faulty IS NOT NULL").count()
        candidates = first_items(sound, fresh, found["mixed"] > 0)
        if limit is not None:
            # Dated and stored: they are cut by their days, and the days of those left are looked at.
            candidates = stored(candidates.withColumn("__day", feed.day(candidates)), "feed-candidates")
        taken = candidates if limit is None else feed.newest(candidates, limit)
        records = feed.feed_records(taken, source, clock, keep=("content_hash",))
        # A row is named by its load and content: two loads at once give no equal ids, and no history is read for them.
        name = F.xxhash64(F.lit(run_id), "tender_no", "content_hash").bitwiseAND(F.lit((1 << 63) - 1))
        batch = records.withColumns({"id": name, "published_at": F.col("published_on").cast("timestamp")}) \
            .select([f.name for f in schema.TENDER.fields])
        loaded = sinks.append_raw(batch, paths["raw"], paths["log"], source, clock, run_id)
        mine = spark.read.schema(schema.RAW_LAYER).parquet(f"{paths['raw']}/run_id={run_id}")
        sinks.append_ledger(mine, paths["ledger"], source, clock, run_id)
        left, day = found["n"] - loaded, F.to_date("published_at")
        ends = mine.agg(F.count("published_at").alias("dated"), F.max(day).alias("newest")).first()
        newest, oldest = ends["newest"], None
        if left:
            # The newest are taken: if a dated item is left, the oldest is.
            all_ends = candidates.agg(F.count("__day").alias("dated"), F.min("__day").alias("oldest")).first()
            oldest = all_ends["oldest"] if all_ends["dated"] > ends["dated"] else None

    # The processed rows of a raw load have a folder of its name: only loads without one are read.
    processed = 0
    waiting = set(waiting_runs(spark, paths["processed"], paths["raw"])) | {run_id}
    for waits in sorted(waiting):
        raw = spark.read.schema(schema.RAW_LAYER).parquet(f"{paths['raw']}/run_id={waits}")
        none = raw.select(F.col("id").alias("raw_id")).where(F.lit(False))
        processed += sinks.append_processed(raw, none, paths["processed"], paths["log"], clock, waits)
    before = registered(spark, lake, source)
    newest, oldest = _ends(before, newest, oldest, since)
    row = (source, "rss", feed_path, clock, loaded, "active", newest, oldest, left)
    sinks.replace_snapshot(spark.createDataFrame([row], schema.SOURCE_REGISTRY), _registry(lake, source))
    return {"loaded": loaded, "duplicate": seen - found["n"], "error": faulty,
            "processed": processed}


def _ends(before: Row | None, newest: date | None, oldest: date | None, since: date | None) -> tuple[date | None, date | None]:
    """The two ends of the mark after a load: items left before ``since`` stay left."""
    if before is not None:
        newest = max(filter(None, (newest, before["newest_item"])), default=None)
        if since is not None and before["oldest_left"] is not None and before["oldest_left"] < since:
            oldest = min(filter(None, (oldest, before["oldest_left"])))
    return newest, oldest


def _registry(lake: str, source: str) -> str:
    return f"{lake.rstrip('/')}/sources/source={hashlib.md5(source.encode()).hexdigest()}"


def registered(spark: SparkSession, lake: str, source: str) -> Row | None:
    """The registry row of a source: its last load, the newest item loaded and the oldest one left unread."""
    versions = folders(spark, _registry(lake, source), "version")
    return spark.read.schema(schema.SOURCE_REGISTRY).parquet(f"{_registry(lake, source)}/version={versions[-1]}").first() \
        if versions else None


def last_load(spark: SparkSession, lake: str, source: str) -> date | None:
    """Where the next load has to start: the day of the newest load, or of the oldest item that loads have left."""
    row = registered(spark, lake, source)
    return None if row is None else min(filter(None, (row["last_load_time"].date(), row["oldest_left"])))


def current_sources(spark: SparkSession, lake: str) -> DataFrame:
    """Registry view: the newest row of every source the loads have recorded."""
    rows = files.read_layer(spark, f"{lake.rstrip('/')}/sources", schema.SOURCE_REGISTRY)
    return layers.upsert_sources(rows.limit(0), rows)
