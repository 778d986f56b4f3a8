"""The bucketed ledger: what is read and moved by a look-up."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tenderlake.operators import ledger

CLOCK = datetime(2024, 2, 1)


@pytest.fixture
def table(spark, tmp_path):
    name = f"ledger_{uuid.uuid4().hex}"
    path = str(tmp_path / "ledger")
    ledger.open_ledger(spark, name, path, 16)
    rows = spark.range(5000).selectExpr("concat('44-', id) AS tender_no", "md5(cast(id AS string)) AS content_hash")
    for k in range(3):
        ledger.enter(rows.where(f"tender_no LIKE '%{k}'"), name, "feed", CLOCK, f"r{k}", 16)
    yield name, path
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def batch(spark, n):
    return spark.range(n).selectExpr("concat('44-', id) AS tender_no", "md5(cast(id AS string)) AS content_hash", "id AS extra")


def test_few_versions_read_their_buckets_only(spark, table):
    found = ledger.known(batch(spark, 4), spark.table(table[0]))
    assert {r.tender_no for r in found.collect()} == {"44-0", "44-1", "44-2"}
    text = plan(found)
    assert "SelectedBucketsCount" in text and "SelectedBucketsCount: 16 out of 16" not in text and "Join" not in text


def test_the_ledger_is_not_shuffled(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ledger.known(batch(spark, 3000), spark.table(table[0]), few=10)
        text = plan(found)
        assert found.count() == 900
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Above the scan of the ledger there is no exchange below the join: only the batch is brought to the buckets.
    lines = text.splitlines()
    scan = next(k for k, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line)
    join = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line)
    assert join < scan and not any("Exchange" in line for line in lines[join + 1:scan])
    assert "hashpartitioning(version" in text


def test_new_rows_and_other_sessions(spark, table):
    name, path = table
    rows = batch(spark, 20).unionByName(spark.createDataFrame([(None, "x", 1), ("44-1", "other", 2), ("44-1", None, 3)],
                                                             "tender_no string, content_hash string, extra long"))
    for few in (500, 2):
        got = sorted((r.tender_no or "", r.content_hash or "") for r in ledger.new_rows(rows, spark.table(name), few).collect())
        assert len(got) == 23 - 6 and ("44-1", "other") in got and ("", "x") in got and ("44-1", "") in got
    other = f"{name}_again"
    assert ledger.open_ledger(spark, other, path, 16).count() == 1500
    spark.sql(f"DROP TABLE {other}")
    # A load that is entered twice changes nothing that a look-up sees.
    ledger.enter(batch(spark, 3), name, "feed", CLOCK, "r0", 16)
    assert ledger.known(batch(spark, 20), spark.table(name)).count() == 6


def test_empty_ledger_and_batch(spark, tmp_path):
    name = f"ledger_{uuid.uuid4().hex}"
    none = ledger.open_ledger(spark, name, str(tmp_path / "none"), 4)
    assert ledger.new_rows(batch(spark, 3), none).count() == 3 and ledger.known(batch(spark, 3).where(F.lit(False)), none).count() == 0
    spark.sql(f"DROP TABLE {name}")
