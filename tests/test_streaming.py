from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tenderlake import schema
from tenderlake.session import scratch_path
from tenderlake.sources import files
from tenderlake.streaming import loads

CLOCK = datetime(2024, 2, 1)
FORM = "tender_no string, description string, budget double, published_at timestamp"


def land(spark, folder, rows):
    spark.createDataFrame(rows, FORM).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    form = spark.createDataFrame([], FORM).schema
    return loads.landed_files(spark, folder, "*.parquet", form, files_per_batch=1)


def test_distinct_loads_keep_late_tenders(spark):
    root = scratch_path(spark, "t")
    at = datetime(2024, 1, 1)
    land(spark, f"{root}/in", [("a", "x", 1.0, at), ("a", "x", 1.0, at), ("b", "x", 1.0, at)])
    rows = loads.distinct_loads(stream(spark, f"{root}/in"), ["tender_no"])
    assert loads.drain(rows, f"{root}/out", f"{root}/state").count() == 2
    # A new tender counts, even one dated years before everything seen so far.
    land(spark, f"{root}/in", [("a", "x", 1.0, at + timedelta(hours=1)), ("c", "x", 1.0, at - timedelta(days=3000))])
    again = loads.distinct_loads(stream(spark, f"{root}/in"), ["tender_no"])
    assert sorted(r.tender_no for r in loads.drain(again, f"{root}/out", f"{root}/state").collect()) == ["a", "b", "c"]


def test_ledger_loader_is_repeatable(spark):
    root = scratch_path(spark, "t")
    at = datetime(2024, 1, 1)
    load = loads.ledger_loader(f"{root}/raw", f"{root}/ledger", "feed", CLOCK, "s1")
    first = spark.createDataFrame([("a", "x", 1.0, at)] * 3 + [("b", "x", 1.0, at)], FORM)
    load(first, 0)
    load(first, 0)
    load(spark.createDataFrame([("a", "x", 2.0, at), ("b", "x", 1.0, at)], FORM), 1)
    assert sorted((r.tender_no, r.budget) for r in spark.read.parquet(f"{root}/raw").collect()) == [
        ("a", 1.0), ("a", 2.0), ("b", 1.0)]
    assert files.read_layer(spark, f"{root}/ledger", schema.LEDGER).count() == 3


def test_streams_share_a_raw_folder(spark):
    root = scratch_path(spark, "t")
    at = datetime(2024, 1, 1)
    rows = {"a": [("a", "x", 1.0, at)], "b": [("b", "x", 1.0, at), ("a", "x", 1.0, at)]}
    for source in ("a", "b", "a"):  # the third is a new stream over a source loaded before
        load = loads.ledger_loader(f"{root}/raw", f"{root}/ledger", source, CLOCK, f"{source}{len(rows)}")
        load(spark.createDataFrame(rows[source], FORM), 0)
        rows["c"] = []
    assert sorted(r.tender_no for r in spark.read.parquet(f"{root}/raw").collect()) == ["a", "b"]
    assert files.read_layer(spark, f"{root}/ledger", schema.LEDGER).count() == 2


def test_windows_count_late_and_last_rows(spark):
    root = scratch_path(spark, "t")
    start = datetime(2024, 1, 1)
    land(spark, f"{root}/in", [(s, "x", 1.0, start + timedelta(minutes=10 * i)) for i in range(30) for s in ("a", "b")])
    count = loads.window_counter(f"{root}/out", "s", "published_at", "tender_no")
    loads.drain_batches(stream(spark, f"{root}/in"), count, f"{root}/state")
    land(spark, f"{root}/in", [("a", "x", 1.0, start)])  # five hours late
    loads.drain_batches(stream(spark, f"{root}/in"), count, f"{root}/state")
    got = {(r.window_start.hour, r.tender_no): r.loads for r in loads.windowed_loads(spark, f"{root}/out", "tender_no").collect()}
    assert got == {**{(h, s): 6 for h in range(5) for s in ("a", "b")}, (0, "a"): 7}


@pytest.mark.parametrize("runs", [1, 2])
def test_promotion_handles_each_row_once(spark, runs):
    root = scratch_path(spark, "t")
    spark.range(5).select("id", F.lit("n").alias("tender_no"), F.lit(2e6).alias("budget"),
                          F.lit(datetime(2024, 8, 1)).alias("published_at")).write.parquet(f"{root}/in")
    form = spark.read.parquet(f"{root}/in").schema
    for _ in range(runs):
        raw = loads.landed_files(spark, f"{root}/in", "*.parquet", form)
        out = loads.drain(loads.promoted(raw, CLOCK), f"{root}/out", f"{root}/state")
    assert [(r.raw_id, r.budget_mln, r.quarter) for r in out.orderBy("raw_id").collect()] == [(i, 2.0, 3) for i in range(5)]
