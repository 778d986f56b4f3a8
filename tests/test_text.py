import datetime

import pytest
from pyspark.sql import functions as F

from tenderlake.functions import dates, numbers, text


def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r.y for r in df.select("i", column("x").alias("y")).orderBy("i").collect()]


def test_feed_dates(spark):
    day = datetime.date(2024, 3, 5)
    inputs = ["Tue, 05 Mar 2024 23:30:00 +0300", "Tue, 5 Mar 2024 01:00:00 GMT", "2024-03-05T23:59:59Z",
              "2024-03-05T00:10:00+03:00", "2024-03-05T10:00:00-05:00", "2024-03-05", "2024-13-45", "soon", "", None]
    assert values(spark, dates.feed_date, inputs) == [day] * 6 + [None] * 4


def test_labels_and_prices(spark):
    visible = "Заказчик:  ГБУ Школа №1 \nРегион: Москва\nНачальная (максимальная) цена: 1 234 567,50 \n"
    assert values(spark, lambda c: text.labelled_value(c, "Заказчик", 100), [visible, "Заказчик:\nООО Ромашка", "нет", None]) \
        == ["ГБУ Школа №1", "ООО Ромашка", text.UNKNOWN, text.UNKNOWN]
    assert values(spark, lambda c: text.labelled_value(c, "Заказчик", 3), [visible]) == ["ГБУ"]
    long = "Заказчик: " + "я" * 500
    assert values(spark, lambda c: text.labelled_value(c, "Заказчик"), [long]) == ["я" * 500]
    assert values(spark, text.labelled_price, [visible, "Начальная цена: 10.5", "Начальная цена: 1.2.3", "цена: 5", None]) \
        == [1234567.5, 10.5, 0.0, 0.0, 0.0]


def test_classifier_order(spark):
    inputs = ["РЕМОНТ ДОРОГ", "Ремонт школы", "Электронный сервер", "озеленение парка", "прочее"]
    assert values(spark, lambda c: text.classify(F.lower(c)), inputs) == ["Транспорт", "Строительство", "Энергетика", "Благоустройство",
                                                    text.UNKNOWN]


def test_purchase_number(spark):
    link = "https://example.org/v?registrationNumber=0373&x=1"
    got = values(spark, text.purchase_number, [link, "https://example.org/other", "https://example.org/other", None])
    assert got[0] == "44-0373" and got[1] == got[2] != got[3] and len(got[1]) == 35


def test_items_without_link_keep_apart(spark):
    df = spark.createDataFrame([(None, "a", "x"), ("", "a", "y"), (None, "a", "x"), (None, None, None)], "l string, t string, d string")
    got = [r[0] for r in df.select(text.purchase_number("l", "t", "d")).collect()]
    assert got[0] == got[2] and len(set(got)) == 3


def test_strip_tags(spark):
    html = "<p class='a>b'>A &amp; B</p><script>var t = '</p>';</script><!-- no --><style>p{}</style> &lt;c&gt;"
    assert values(spark, text.strip_tags, ["<b>x</b>y", html.replace("'a>b'", "'a'")]) == ["xy", "A & B <c>"]


def test_content_hash_prints_money_the_same(spark):
    df = spark.createDataFrame([(12345678.5,), (1.0,), (None,)], "b double")
    got = [r[0] for r in df.select(F.concat(F.lit("n"), F.lit("d"), F.col("b").cast("decimal(20,2)").cast("string"))).collect()]
    assert got[:2] == ["nd12345678.50", "nd1.00"]
    hashes = [r[0] for r in df.select(text.content_hash(F.lit("n"), F.lit("d"), "b")).collect()]
    assert len(set(hashes)) == 3 and all(len(h) == 32 for h in hashes)


def brute_grams(s, low=2, high=3):
    import re

    s = re.sub(r"\s\s+", " ", s.lower())
    return [s[i:i + n] for n in range(low, high + 1) for i in range(len(s) - n + 1)]


@pytest.mark.parametrize("s", ["", "a", "ab", "Дом  \n у реки", "x 😀 y", "aaaa", "tab\t\tend", "nbsp  end"])
def test_char_grams(spark, s):
    assert values(spark, text.char_grams, [s])[0] == brute_grams(s)


def test_case_folding_is_literal_and_unicode(spark):
    assert values(spark, lambda c: text.contains_any_case(c, "шКоЛа"), ["СРЕДНЯЯ ШКОЛА", "дом"]) == [True, False]
    assert values(spark, lambda c: text.contains_any_case(c, "_%"), ["a_%b", "axyb"]) == [True, False]


def test_numbers(spark):
    assert values(spark, numbers.as_double, ["1", " 2.5 ", "x", None]) == [1.0, 2.5, None, None]
    assert values(spark, numbers.percent_text, [0.4213], "double") == ["42.1%"]
    df = spark.range(20000).select(numbers.stable_normal("id", 1).alias("z"), numbers.stable_uniform("id", 1).alias("u"))
    r = df.agg(F.avg("z"), F.stddev_pop("z"), F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(r[0]) < 0.03 and abs(r[1] - 1) < 0.03 and abs(r[2] - 0.5) < 0.01 and 0 < r[3] and r[4] < 1


def test_padded_number(spark):
    assert values(spark, text.padded_number, [0, 41, 12345678], "long") == ["44-1000000", "44-1000041", "44-13345678"]


def test_one_decimal_rounds_the_exact_value(spark):
    inputs = [99.25, 0.25, 0.75, 0.15, 0.05, 12.35, 99.95, 99.96, 1e-9, -2.25, -0.04, 28.749999999999996, 0.0, 123456789.25] + \
        [n / 4 for n in range(1, 400, 2)] + [n / 20 for n in range(1, 400, 2)]
    assert values(spark, numbers.one_decimal, inputs, "double") == [f"{x:.1f}" for x in inputs]
    assert values(spark, numbers.percent_text, [0.9925, None], "double") == ["99.2%", None]
