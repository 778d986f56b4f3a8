from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tenderlake import schema, sinks
from tenderlake.operators import layers, layout
from tenderlake.plans import feed_ingest
from tenderlake.session import folders, scratch_path, stored
from tenderlake.sources import feed, files, tables

CLOCK = datetime(2024, 2, 1, 12, 0)


def test_null_reference_does_not_hide_raw_rows(spark):
    raw = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, tender_no string")
    done = spark.createDataFrame([(1,), (1,), (None,)], "raw_id long")
    assert sorted(r.id for r in layers.unprocessed(raw, done).collect()) == [2, 3]


def test_enrich_keeps_available_columns(spark):
    raw = spark.createDataFrame([(1, "n1", 2_500_000.0, "2024-05-06"), (2, "n2", None, "bad")],
                                "id long, tender_no string, budget double, published_at string")
    out = layers.enrich(raw, CLOCK)
    assert out.columns == ["tender_no", "budget", "budget_mln", "month", "quarter", "processed_at", "raw_id"]
    got = {r.raw_id: (r.budget_mln, r.month, r.quarter) for r in out.collect()}
    assert got == {1: (2.5, 5, 2), 2: (None, None, None)}


def test_load_outcome_counts_every_row(spark):
    batch = spark.createDataFrame([("a", "1")] * 5 + [("b", "1"), ("b", "2"), (None, "3")],
                                  "tender_no string, content_hash string")
    ledger = spark.createDataFrame([("b", "1"), ("b", "1")], "tender_no string, content_hash string")
    assert tuple(layers.load_outcome(batch, ledger).first()) == (2, 5, 1)
    assert tuple(layers.load_outcome(batch.limit(0), ledger).first()) == (0, 0, 0)
    # Same number, other content: a new version.
    assert {r.tender_no + r.content_hash for r in layers.not_loaded(batch.dropna(), ledger).collect()} == {"a1", "b2"}


def test_insert_or_ignore_first_writer_wins(spark, rows):
    batch = spark.createDataFrame([("x", 2, "late"), ("x", 1, "early"), ("y", 1, "known"), (None, 1, "no key")],
                                  "k string, o int, v string")
    target = spark.createDataFrame([("y",), (None,)], "k string")
    assert rows(layers.insert_or_ignore(batch, target, "k", ["o"]).select("k", "v")) == [("x", "early")]


def test_registry_upsert(spark):
    at = [datetime(2024, 1, d) for d in (1, 2, 3)]
    form = "name string, last_load_time timestamp, last_load_count long, status string"
    registry = spark.createDataFrame([("a", at[1], 5, "active"), ("b", None, None, "new")], form)
    updates = spark.createDataFrame([("a", at[2], 7, "active"), ("a", at[0], 1, "old"), ("c", at[0], 2, "active")], form)
    got = {r.name: r.last_load_count for r in layers.upsert_sources(registry, updates).collect()}
    assert got == {"a": 7, "b": None, "c": 2}
    assert [r.name for r in layers.source_stats(layers.upsert_sources(registry, updates)).collect()] == ["a", "c", "b"]


def test_counts_without_raw_rows(spark):
    raw = spark.createDataFrame([], "id long")
    row = layers.layer_counts(raw, raw).first()
    assert (row.raw_count, row.processed_count, row.processed_pct) == (0, 0, None)


def test_failed_load_is_logged_and_raised(spark):
    root = scratch_path(spark, "fail")
    bad = spark.range(3).select(F.raise_error(F.lit("broken row")).alias("x"))
    with pytest.raises(Exception, match="broken row"):
        sinks.append_raw(bad, f"{root}/raw", f"{root}/log", "s", CLOCK, "r1")
    log = files.read_layer(spark, f"{root}/log", schema.ETL_LOG).first()
    assert (log.stage, log.status, log.records_count) == ("RAW", "ERROR", 0) and "broken row" in log.error_message


def test_readers(spark, tmp_path):
    path = tmp_path / "upload.csv"
    path.write_text("﻿tender_no,organization,category,region,budget\n0012,Школа,IT,Москва,5\n", encoding="utf-8")
    row = files.read_upload(spark, str(path)).first()
    assert (row.tender_no, row.organization, row.budget) == ("0012", "Школа", 5.0)
    (tmp_path / "short.csv").write_text("tender_no,region\nn1,Москва\n", encoding="utf-8")
    with pytest.raises(ValueError, match="organization"):
        files.read_upload(spark, str(tmp_path / "short.csv"))
    with pytest.raises(ValueError, match="unsupported"):
        files.read_any(spark, "x.xlsx")
    assert files.read_layer(spark, str(tmp_path / "none"), schema.TENDER).columns == schema.TENDER.names


def test_table_fallback(spark):
    spark.range(3).createOrReplaceTempView("fallback_rows")
    spark.range(0).createOrReplaceTempView("empty_rows")
    for name in ("empty_rows", "missing_rows"):
        assert tables.scan_table(spark, name, "fallback_rows", ["id"], 2).count() == 2
        assert tables.count_table(spark, name, "fallback_rows").first()[0] == 3
    assert tables.count_table(spark, "missing_rows", "empty_rows").first()[0] == 0


def test_layout(spark):
    df = layout.spread_rows(spark.range(100), 4)
    row = layout.partition_summary(df).first()
    assert (row.total_records, row.num_partitions, row.avg_per_partition) == (100, 4, 25.0)
    emptied = layout.partition_summary(df.where("id < 0")).first()
    assert (emptied.total_records, emptied.num_partitions, emptied.avg_per_partition) == (0, 4, 0.0)
    with layout.cached(df) as kept:
        assert kept.is_cached
    assert not df.is_cached
    path = sinks.write_parquet(df, scratch_path(spark, "size"))
    size = layout.stored_bytes(spark, path).first()
    assert size.files >= 4 and size.bytes > 0
    facts = {r.fact: r.value for r in layout.run_facts(spark).collect()}
    assert facts["spark.version"].startswith(spark.version) and facts["spark.sql.shuffle.partitions"] == "8"


def item(number, price, title="Ремонт"):
    return (f"<item><title>{title}</title><link>https://example.org/?registrationNumber={number}</link>"
            f"<published>Tue, 05 Mar 2024 10:00:00 +0300</published>"
            f"<description>&lt;p&gt;Заказчик: ГБУ&lt;/p&gt;&lt;p&gt;\nНачальная цена: {price}&lt;/p&gt;</description></item>")


def land(folder, name, *items):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(f"<rss><channel>{''.join(items)}</channel></rss>", encoding="utf-8")


def outcome(loaded, duplicate=0, error=0, processed=None):
    return {"loaded": loaded, "duplicate": duplicate, "error": error, "processed": loaded if processed is None else processed}


def test_feed_ingest_over_several_loads(spark, tmp_path, rows):
    feed_dir, lake = tmp_path / "feed", str(tmp_path / "lake")
    land(feed_dir, "a.xml", item(1, 10), item(1, 10), item(2, 20))
    load = lambda run: feed_ingest.run(spark, str(feed_dir), lake, "feed", CLOCK, run)
    assert load("r1") == outcome(2, 1)
    assert load("r2") == outcome(0, 3)
    land(feed_dir, "b.xml", item(2, 25), item(3, 30))
    assert load("r3") == outcome(2, 3)
    # Repeating a load replaces its own rows.
    assert load("r3") == outcome(2, 3)

    raw = files.read_layer(spark, f"{lake}/raw", schema.RAW_LAYER)
    assert rows(raw.select("tender_no", "budget")) == [("44-1", 10.0), ("44-2", 20.0), ("44-2", 25.0), ("44-3", 30.0)]
    assert raw.select("id").distinct().count() == 4
    processed = files.read_layer(spark, f"{lake}/processed", schema.PROCESSED_LAYER)
    assert {(r.raw_id, r.month) for r in processed.collect()} == {(r.id, 3) for r in raw.collect()}
    assert files.read_layer(spark, f"{lake}/ledger", schema.LEDGER).count() == 4
    assert feed_ingest.current_sources(spark, lake).count() == 1
    assert feed_ingest.last_load(spark, lake, "feed") == CLOCK.date()


def test_malformed_items_cost_no_others(spark, tmp_path):
    feed_dir, lake = tmp_path / "feed", str(tmp_path / "lake")
    land(feed_dir, "a.xml", item(1, 10), "<item><title>broken</item>", item(2, 20), "<item><title>x & y</title></item>", item(3, 5))
    assert feed_ingest.run(spark, str(feed_dir), lake, "feed", CLOCK, "r1") == outcome(3, 0, 2)


def test_limited_loads_reach_every_item(spark, tmp_path):
    feed_dir, lake = tmp_path / "feed", str(tmp_path / "lake")
    land(feed_dir, "a.xml", *[item(k, k) for k in range(1, 6)])
    loaded = [feed_ingest.run(spark, str(feed_dir), lake, "feed", CLOCK, f"r{k}", limit=2)["loaded"] for k in range(4)]
    assert loaded == [2, 2, 1, 0]


def test_unclosed_item_costs_itself_only(spark, tmp_path):
    feed_dir = tmp_path / "feed"
    inside = item(4, 4, title="<![CDATA[a <item> in text]]>")
    land(feed_dir, "a.xml", item(1, 10), item(2, 20).removesuffix("</item>"), item(3, 30), inside, "<!-- <item> -->",
         "<item attr='x'><title>plain</title></item>", "<items><title>no item</title></items>", "<item>")
    found = feed.read_feed(spark, str(feed_dir)).collect()
    assert sorted(r.link[-1] for r in found if r.link) == ["1", "3", "4"]
    assert sorted(r.title for r in found if r.title) == ["a <item> in text", "plain", "Ремонт", "Ремонт"]
    assert sum(r.faulty is not None for r in found) == 2
    assert feed_ingest.run(spark, str(feed_dir), str(tmp_path / "lake"), "feed", CLOCK, "r1") == outcome(4, 0, 2)


def test_long_items(spark, tmp_path):
    feed_dir = tmp_path / "feed"
    land(feed_dir, "a.xml", item(1, 10, title="&lt;b&gt;" * 60_000), item(2, 1, title="<![CDATA[" + "]>- <a" * 60_000 + "]]>"))
    assert sorted(len(r.title) for r in feed.read_feed(spark, str(feed_dir)).collect()) == [180_000, 360_000]


def test_declared_encodings(spark, tmp_path):
    feed_dir = tmp_path / "feed"
    feed_dir.mkdir()
    head = "<?xml version='1.0' encoding='{}'?><rss>{}</rss>"
    for k, name in enumerate(["windows-1251", "KOI8-R", "UTF-8", "cp866"]):
        (feed_dir / f"{k}.xml").write_bytes(head.format(name, item(k, k) + item(10 + k, k)).encode(name))
    (feed_dir / "bare.xml").write_text(item(5, 5), encoding="utf-8")
    found = feed.read_feed(spark, str(feed_dir)).collect()
    assert len(found) == 9 and {r.title for r in found} == {"Ремонт"}
    (feed_dir / "odd.xml").write_bytes(head.format("x-none", item(6, 6)).encode("windows-1251"))
    (feed_dir / "bad.xml").write_bytes(item(7, 7).encode("windows-1251"))
    found = feed.read_feed(spark, str(feed_dir)).collect()
    assert len(found) == 11 and sum(r.faulty is not None for r in found) == 2


def test_limited_loads_with_the_mark_reach_every_item(spark, tmp_path):
    from datetime import date, datetime

    feed_dir, lake = tmp_path / "feed", str(tmp_path / "lake")
    dated = [item(k, k).replace("05 Mar", f"{k:02d} Jan") for k in range(1, 9)] + [item(9, 9).replace("Tue, 05", "no")]
    land(feed_dir, "a.xml", *dated)
    load = lambda k: feed_ingest.run(spark, str(feed_dir), lake, "feed", datetime(2024, 2, k), f"r{k}", limit=2,
                                     since=feed_ingest.last_load(spark, lake, "feed"))["loaded"]
    assert load(1) == 2
    row = feed_ingest.registered(spark, lake, "feed")
    assert (row.newest_item, row.oldest_left, row.left_count) == (date(2024, 1, 8), date(2024, 1, 1), 7)
    assert [load(k) for k in range(2, 7)] == [2, 2, 2, 1, 0]
    raw = files.read_layer(spark, f"{lake}/raw", schema.RAW_LAYER)
    assert sorted(r.tender_no for r in raw.collect()) == [f"44-{k}" for k in range(1, 10)]
    assert feed_ingest.registered(spark, lake, "feed").oldest_left is None
    assert feed_ingest.last_load(spark, lake, "feed") == date(2024, 2, 6)


def test_items_left_before_a_later_mark_stay_left(spark, tmp_path):
    from datetime import date

    feed_dir, lake = tmp_path / "feed", str(tmp_path / "lake")
    land(feed_dir, "a.xml", *[item(k, k).replace("05 Mar", f"{k:02d} Jan") for k in range(1, 7)])
    run = lambda k, since: feed_ingest.run(spark, str(feed_dir), lake, "feed", CLOCK, f"r{k}", limit=2, since=since)["loaded"]
    assert run(1, None) == 2
    assert run(2, date(2024, 1, 4)) == 1
    assert feed_ingest.last_load(spark, lake, "feed") == date(2024, 1, 1)


def test_registry_keeps_one_snapshot_and_the_one_before(spark, tmp_path):
    path = str(tmp_path / "registry")
    for k in range(12):
        sinks.replace_snapshot(spark.createDataFrame([(k,)], "k int"), path)
    assert [int(v) for v in folders(spark, path, "version")] == [11, 12]
    # A writer that stopped half-way has left no mark.
    (tmp_path / "registry" / "version=000000000013").mkdir()
    assert int(folders(spark, path, "version")[-1]) == 12
    sinks.replace_snapshot(spark.createDataFrame([(99,)], "k int"), path)
    assert spark.read.parquet(f"{path}/version=000000000013").first().k == 99


def test_ledger_is_neither_shuffled_nor_written(spark, tmp_path):
    ledger = spark.range(200_000).selectExpr("concat('44-', id) AS tender_no", "md5(cast(id AS string)) AS content_hash", "'r' AS run_id")
    ledger = stored(ledger, "big-ledger")
    asked = stored(ledger.limit(100).select("tender_no", "content_hash"), "asked")
    plan = feed_ingest.asked_versions(asked, ledger, ledger.limit(0).withColumns({"description": F.lit(""), "budget": F.lit(0.0)}), [])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and plan.count() == 100


def test_mark_leaves_out_old_items(spark, tmp_path):
    from datetime import date

    feed_dir, lake = tmp_path / "feed", str(tmp_path / "lake")
    land(feed_dir, "a.xml", item(1, 10), item(2, 20).replace("05 Mar 2024", "05 Mar 2023"), item(3, 1).replace("Tue, 05", "no"))
    run = feed_ingest.run(spark, str(feed_dir), lake, "feed", CLOCK, "r1", since=date(2024, 1, 1))
    assert run == outcome(2)


def test_titles_count_whole(spark, tmp_path):
    feed_dir, lake = tmp_path / "feed", str(tmp_path / "lake")
    land(feed_dir, "a.xml", item(1, 10, "т" * 250 + "a"), item(1, 10, "т" * 250 + "b"))
    assert feed_ingest.run(spark, str(feed_dir), lake, "feed", CLOCK, "r1")["loaded"] == 2
    raw = files.read_layer(spark, f"{lake}/raw", schema.RAW_LAYER)
    assert {len(r.description) for r in raw.collect()} == {251}


def test_increment_reads_open_runs_only(spark, tmp_path):
    feed_dir, lake = tmp_path / "feed", str(tmp_path / "lake")
    land(feed_dir, "a.xml", item(1, 10))
    feed_ingest.run(spark, str(feed_dir), lake, "feed", CLOCK, "r1")
    raw = files.read_layer(spark, f"{lake}/raw", schema.RAW_LAYER)
    ledger = files.read_layer(spark, f"{lake}/ledger", schema.LEDGER)
    assert feed_ingest.open_runs(ledger, raw) == []
    assert feed_ingest.open_runs(ledger.where("false"), raw) == ["r1"]
    plan = feed_ingest.known_versions(ledger.where("run_id = 'x'"), raw)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan or "PartitionFilters: [run_id" in plan


def test_insert_or_ignore_is_repeatable(spark, rows):
    path, target = scratch_path(spark, "ignore"), spark.createDataFrame([("a", 0)], "k string, o int")
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1)], "k string, o int")
    for _ in range(2):
        sinks.insert_or_ignore(batch, target, path, "k", ["o"], "r1")
    assert rows(spark.read.parquet(path).select("k", "o")) == [("b", 1)]


def test_feed_load_that_stopped_before_its_ledger(spark, tmp_path):
    import shutil

    feed_dir, lake = tmp_path / "feed", tmp_path / "lake"
    land(feed_dir, "a.xml", item(1, 10), item(2, 20))
    feed_ingest.run(spark, str(feed_dir), str(lake), "feed", CLOCK, "r1")
    shutil.rmtree(lake / "ledger")
    assert feed_ingest.run(spark, str(feed_dir), str(lake), "feed", CLOCK, "r2") == outcome(0, 2)


def test_retention_touches_no_other_day(spark, tmp_path):
    from datetime import date

    path = str(tmp_path / "days")
    rows = spark.createDataFrame([(k, datetime(2024, 1, 1 + k % 5)) for k in range(50)] + [(99, None)], "k int, at timestamp")
    sinks.write_by_day(rows, path, "at")
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "days").rglob("*.parquet")}
    assert sinks.drop_days(spark, path, date(2024, 1, 3)) == ["2024-01-01", "2024-01-02"]
    left = {f: f.stat().st_mtime_ns for f in (tmp_path / "days").rglob("*.parquet")}
    assert left.items() <= before.items() and spark.read.parquet(path).count() == 31
    # A day that comes again is replaced, the others stay.
    sinks.write_by_day(spark.createDataFrame([(1, datetime(2024, 1, 5))], "k int, at timestamp"), path, "at")
    assert spark.read.parquet(path).count() == 22
    assert sum(f in left and f.stat().st_mtime_ns == left[f] for f in (tmp_path / "days").rglob("*.parquet")) >= 3


def test_totals_read_sketches_only(spark, tmp_path):
    from tenderlake.operators import sketches

    path = str(tmp_path / "sketches")
    rows = spark.range(20_000).selectExpr("concat('c', id % 7) AS category", "concat('r', id % 90) AS region", "concat('o', id) AS organization",
                                          "'x' AS status", "CAST(id AS double) AS budget", "id % 3 AS run")
    for k in (0, 1, 2, 1):
        sinks.write_sketch(rows.where(f"run = {k}"), path, f"r{k}")
    sinks.write_sketch(rows.where("false"), path, "empty")
    found = sketches.merged_stats(spark.read.parquet(path))
    row = found.first()
    assert (row.total_count, row.category_count, row.region_count, row.status_count, row.min_budget, row.max_budget) == (
        20_000, 7, 90, 1, 0.0, 19_999.0)
    assert abs(row.organization_count / 20_000 - 1) < 0.03 and row.avg_budget == pytest.approx(9999.5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "sketches" in plan
    none = sketches.merged_stats(spark.read.parquet(path).where("false")).first()
    assert (none.total_count, none.organization_count, none.total_budget) == (0, 0, 0.0)


def test_only_small_results_are_brought(spark):
    assert [r.id for r in sinks.brought(spark.range(3), most=3)] == [0, 1, 2]
    with pytest.raises(ValueError):
        sinks.brought(spark.range(4), most=3)
