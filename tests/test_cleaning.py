import pytest
from pyspark.sql import functions as F

from tenderlake.operators import cleaning, dedup, filters
from tenderlake.plans import batch_etl


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame(
        [(1, "12", 10.0, 2, "2024-01-31"), (1, "12", 10.0, 2, "2024-01-31"), (2, "x", None, 0, "bad"),
         (3, None, 30.0, None, "2024-02-29"), (4, "1e3", 5.0, 4, None)],
        "id long, code string, sum_value double, quantity int, date string")


def test_distinct_and_missing(dirty, rows):
    assert dedup.distinct_rows(dirty).count() == 4
    assert rows(cleaning.drop_missing(dirty).select("id").distinct()) == [(1,)]
    assert cleaning.handle_missing(dirty, "none").count() == 5


def test_fill_with_mean(dirty, rows):
    filled = cleaning.fill_with_mean(dirty).select("id", "sum_value", "quantity").distinct()
    # mean 13.75; integer mean of 2, 2, 0, 4 is 2
    assert rows(filled) == [(1, 10.0, 2), (2, 13.75, 0), (3, 30.0, 2), (4, 5.0, 4)]


def test_column_without_values_stays_null(spark):
    df = spark.createDataFrame([(None, 1)], "a double, b int")
    assert cleaning.fill_with_mean(df).first().a is None


def test_number_text(dirty):
    assert {r.code for r in cleaning.normalise_number_text(dirty).collect()} == {"12.0", "x", None, "1000.0"}
    assert dict(cleaning.promote_numeric_text(dirty.where("id in (1, 4)")).dtypes)["code"] == "double"
    assert dict(cleaning.promote_numeric_text(dirty).dtypes)["code"] == "string"


def test_unit_price_and_date_parts(dirty, rows):
    priced = cleaning.add_date_parts(cleaning.add_unit_price(dirty.dropDuplicates()))
    assert rows(priced.select("id", "unit_price", "year", "month", "day")) == [
        (1, 5.0, 2024, 1, 31), (2, 0.0, None, None, None), (3, 0.0, 2024, 2, 29), (4, 1.25, None, None, None)]


def test_cast_by_role_by_name(dirty):
    kinds = dict(cleaning.cast_by_role(dirty.withColumn("sum_value", F.col("sum_value").cast("string"))).dtypes)
    assert (kinds["sum_value"], kinds["date"], kinds["code"]) == ("double", "timestamp", "string")


def test_rules_split_rows(dirty, rows):
    rules = {"positive": F.col("quantity") > 0, "priced": F.col("sum_value").isNotNull()}
    good, bad = cleaning.keep_valid(dirty, rules), cleaning.quarantine(dirty, rules)
    assert good.count() + bad.count() == dirty.count()
    assert rows(bad.select("id", "failed_rule")) == [(2, "positive"), (3, "positive")]
    assert cleaning.keep_valid(dirty, {}).count() == 5 and cleaning.quarantine(dirty, {}).count() == 0


def test_keep_first_of_hot_key(spark, rows):
    i = F.col("id")
    df = spark.range(2000).select(F.when(i % 3 == 0, -1).otherwise(i).alias("k"), (2000 - i).alias("o"), i.alias("v"))
    first = dedup.keep_first(df, ["k"], ["o"])
    assert first.count() == df.select("k").distinct().count()
    assert rows(first.where("k = -1")) == [(-1, 2, 1998)]
    assert rows(dedup.keep_last(df, ["k"], ["o"]).where("k = -1")) == [(-1, 2000, 0)]
    report = dedup.duplicate_report(df, ["k"]).first()
    assert report.initial_count == 2000 and report.removed == 2000 - report.final_count


def test_where_values(dirty):
    assert filters.where_values(dirty, {"id": [1, 2], "nothing": 3}).count() == 3
    assert filters.where_values(dirty, {"code": "x"}).count() == 1


def test_transform_pipeline(spark, dirty):
    out = batch_etl.transform(dirty).collect()
    assert [(r.id, r.code, r.unit_price, r.month) for r in out] == [(1, "12.0", 5.0, 1)]
    assert batch_etl.clean(dirty).count() == 1
