"""The shape of plans that decides how they scale, and the scaling study."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tenderlake.catalog import fixtures as fx
from tenderlake.operators import aggregates, filters, regression, search, similarity, trends
from tenderlake.plans import scaling
from tenderlake.sources import feed, synthetic

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tenders(spark):
    return fx.tenders(spark, SF_DIR)


def test_filter_and_columns_reach_the_scan(spark):
    orders = fx.table(spark, SF_DIR, "orders")
    text = plan(filters.where_values(orders, {"o_orderstatus": "F"}).groupBy("o_orderpriority").count())
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in text


def test_top_k_needs_no_full_sort(tenders):
    for df in (filters.by_budget(tenders, 1, 2), search.full_search(tenders, "build"),
               aggregates.top_groups_by_sum(tenders, "region")):
        text = plan(df)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_aggregates_combine_before_the_shuffle(tenders):
    assert "partial_sum" in plan(aggregates.by_dimensions(tenders.withColumn("sum_value", F.col("budget"))))
    assert "partial_sum" in plan(trends.daily_sum(tenders, "category"))


def test_similarity_moves_texts_once(spark):
    docs = fx.table(spark, SF_DIR, "documents").select("doc_id", "text")
    placed, _ = similarity.placed_texts(docs, "doc_id", "text")
    counts = similarity.term_counts(placed, "doc_id", "text")
    assert plan(counts).count("Exchange") == 1


def test_no_query_runs_python_per_row(spark):
    names = ["rank_in_category", "semantic_search", "feed_records", "etl_transform", "similar_documents", "full_search",
             "describe_budget", "promote_increment"]
    for name in names:
        text = plan(entry.queries()[name](spark, SF_DIR))
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_synthetic_rows_do_not_depend_on_placement(spark):
    a = synthetic.generate_tenders(spark, 500, date(2024, 1, 1), partitions=1)
    b = synthetic.generate_tenders(spark, 500, date(2024, 1, 1), partitions=7)
    assert a.exceptAll(b).count() == 0
    logs = a.select(F.avg(F.log("budget")), F.stddev_pop(F.log("budget"))).first()
    assert logs[0] == pytest.approx(10, abs=0.4) and logs[1] == pytest.approx(2, abs=0.3)


def test_scaling_study(spark):
    out = scaling.run(spark, [100, 200], lambda n: synthetic.generate_tenders(spark, n, date(2024, 1, 1))).collect()
    assert [r.records for r in out] == [100, 200]
    assert all(r.rows_per_second == pytest.approx(r.records / r.total_seconds) for r in out)
    runs = spark.createDataFrame([(n, 2e-6 * n) for n in (1000, 2000, 5000)], "records long, total_seconds double")
    verdict = scaling.verdict(runs).first()
    assert verdict.is_linear and verdict.complexity == "linear" and verdict.slope == pytest.approx(1)


def test_fits_equal_numpy(spark):
    x = np.arange(1.0, 40)
    y = 3 * x ** 1.5 + np.sin(x)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    row = regression.origin_fit(df, "x", "y").first()
    a = np.sum(x * y) / np.sum(x * x)
    r2 = 1 - np.sum((y - a * x) ** 2) / np.sum((y - y.mean()) ** 2)
    assert row.coefficient == pytest.approx(a) and row.r_squared == pytest.approx(r2)
    slope, intercept = np.polyfit(np.log(x), np.log(y), 1)
    row = regression.power_fit(df, "x", "y").first()
    assert (row.slope, row.intercept) == pytest.approx((slope, intercept)) and row.complexity == "acceptable"


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (99.9,), (100.0,), (None,)], "budget double")
    got = {r.bin: r["count"] for r in aggregates.histogram(df).collect()}
    assert got == {1: 2, 50: 2}
    constant = spark.createDataFrame([(7.0,), (7.0,)], "budget double")
    assert [(r.bin, r["count"]) for r in aggregates.histogram(constant).collect()] == [(1, 2)]


def test_trend_of_one_day_has_no_change(spark):
    df = spark.createDataFrame([("2024-01-01", 5.0), ("2024-01-01", 6.0)], "published_at string, budget double")
    row = trends.trend_summary(df).first()
    assert (row.periods, row.max_total, row.change_pct) == (1, 11.0, 0.0)


def test_log_lines(spark):
    lines = spark.createDataFrame([("2024-01-01 10:00:00 - x - ERROR - late",), ("2024-01-01 09:00:00 - x - INFO - ok",),
                                   ("2024-01-01 08:00:00 - x - ERROR - early",)], "value string")
    assert [r.line[-5:] for r in trends.log_lines(lines, "ERROR").collect()] == [" late", "early"]
    assert trends.log_lines(lines, last=2).count() == 2


def test_large_limits_are_cut_by_days(spark, monkeypatch):
    rows = [(f"l{k:04d}" if k % 7 else None, f"t{k % 3}", None if k % 4 == 3 else f"2024-01-{k % 9 + 1:02d}") for k in range(200)]
    items = spark.createDataFrame(rows, "link string, title string, published string").repartition(5)
    small = {n: sorted(map(str, feed.newest(items, n).collect())) for n in (1, 40, 129, 150, 151, 190, 200, 300)}
    monkeypatch.setattr(feed, "FEW", 0)
    for n, want in small.items():
        taken = feed.newest(items, n)
        # No task keeps and merges the rows of the limit.
        assert "TakeOrdered" not in taken._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(str, taken.collect()))
        assert len(got) == min(n, 200)
        assert [r.count("published=None") for r in got].count(1) == [r.count("published=None") for r in want].count(1)
        if n >= 200 or n == 150:
            assert got == want


def test_texts_of_a_feed_are_not_shuffled_by_file(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.xml").write_text(f"<channel><item><title>{name}</title><link>l</link></item></channel>")
    read = feed.read_feed(spark, str(tmp_path))
    assert sorted(r.title for r in read.collect()) == ["a", "b"]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
