"""Cleaning, typing and de-duplication over the dirty tender table."""

from pyspark.sql import functions as F

from tenderlake.catalog import fixtures as fx
from tenderlake.catalog.registry import DAY, SECOND, as_text, query, rounded
from tenderlake.functions import dates, numbers, text
from tenderlake.operators import cleaning, dedup
from tenderlake.plans import batch_etl


def _d(body: str) -> str:
    return fx.over("dirty_tenders", body=body)


_COLUMNS = ["id", "tender_no", "organization", "category", "region", "budget_text", "budget", "quantity", "date_text"]
_LIST = ", ".join(_COLUMNS)
_COMPLETE = "organization IS NOT NULL AND budget_text IS NOT NULL AND budget IS NOT NULL"
_DATE = "try_cast(date_text AS date)"


@query("distinct_rows", _d(f"SELECT DISTINCT {_LIST} FROM dirty_tenders"))
def _(spark, sf_dir):
    return dedup.distinct_rows(fx.dirty_tenders(spark, sf_dir))


@query("keep_first_per_key", _d("""
    SELECT organization, id, tender_no, category, date_text FROM (
      SELECT *, row_number() OVER (PARTITION BY organization ORDER BY date_text DESC, id) AS rn
      FROM (SELECT * FROM dirty_tenders WHERE date_text <> 'bad') v) r WHERE rn = 1"""))
def _(spark, sf_dir):
    dated = fx.dirty_tenders(spark, sf_dir).where("date_text <> 'bad'")
    # Latest date first, then the smaller id: a last row in (date, -id) order.
    return dedup.keep_last(dated, ["organization"], ["date_text", -F.col("id")]) \
        .select("organization", "id", "tender_no", "category", "date_text")


@query("duplicate_report", _d("""
    SELECT count(*) AS initial_count, count(DISTINCT id) AS final_count, count(*) - count(DISTINCT id) AS removed
    FROM dirty_tenders"""))
def _(spark, sf_dir):
    return dedup.duplicate_report(fx.dirty_tenders(spark, sf_dir), ["id"])


@query("drop_missing", _d(f"SELECT {_LIST} FROM dirty_tenders WHERE {_COMPLETE}"))
def _(spark, sf_dir):
    return cleaning.drop_missing(fx.dirty_tenders(spark, sf_dir))


@query("fill_with_mean", _d("""
    SELECT id, round(coalesce(budget, (SELECT avg(budget) FROM dirty_tenders)), 2) AS budget,
           coalesce(quantity, CAST(trunc((SELECT avg(quantity) FROM dirty_tenders)) AS bigint)) AS quantity
    FROM dirty_tenders"""))
def _(spark, sf_dir):
    return rounded(cleaning.handle_missing(fx.dirty_tenders(spark, sf_dir), "mean").select("id", "budget", "quantity"))



def _rules():
    return {"has_organization": F.col("organization").isNotNull(), "has_budget": F.col("budget") > 0,
            "has_quantity": F.col("quantity") > 0}


@query("keep_valid", _d("""
    SELECT id, organization, budget, quantity FROM dirty_tenders
    WHERE organization IS NOT NULL AND budget > 0 AND quantity > 0"""))
def _(spark, sf_dir):
    return cleaning.keep_valid(fx.dirty_tenders(spark, sf_dir), _rules()).select("id", "organization", "budget", "quantity")


@query("quarantine", _d("""
    SELECT id, failed_rule FROM (
      SELECT id, CASE WHEN organization IS NULL THEN 'has_organization'
                      WHEN budget IS NULL OR budget <= 0 THEN 'has_budget'
                      WHEN quantity <= 0 THEN 'has_quantity' END AS failed_rule FROM dirty_tenders) f
    WHERE failed_rule IS NOT NULL"""))
def _(spark, sf_dir):
    return cleaning.quarantine(fx.dirty_tenders(spark, sf_dir), _rules()).select("id", "failed_rule")


@query("cast_by_role", _d(f"""
    SELECT id, try_cast(budget_text AS double) AS budget_text, strftime({_DATE}, '%Y-%m-%d %H:%M:%S') AS date_text
    FROM dirty_tenders"""))
def _(spark, sf_dir):
    frame = fx.dirty_tenders(spark, sf_dir).select("id", "budget_text", "date_text")
    return as_text(cleaning.cast_by_role(frame), date_text=SECOND)


@query("promote_numeric_text", _d("""
    SELECT CAST(quantity AS double) AS quantity_text, budget_text, count(*) AS n
    FROM dirty_tenders GROUP BY quantity, budget_text"""))
def _(spark, sf_dir):
    frame = fx.dirty_tenders(spark, sf_dir).select(F.col("quantity").cast("string").alias("quantity_text"), "budget_text")
    return cleaning.promote_numeric_text(frame).groupBy("quantity_text", "budget_text").agg(F.count(F.lit(1)).alias("n"))


# The printed form of large doubles differs between engines, so values are compared as numbers.
@query("normalise_number_text", _d("""
    SELECT id, category, CAST(quantity AS double) AS as_number, budget_text = 'n/a' AS kept_word
    FROM dirty_tenders WHERE budget_text IS NOT NULL"""))
def _(spark, sf_dir):
    frame = fx.dirty_tenders(spark, sf_dir).where("budget_text is not null") \
        .select("id", "category", F.col("quantity").cast("string").alias("q"), "budget_text")
    done = cleaning.normalise_number_text(frame)
    return done.select("id", "category", F.when(F.col("q").endswith(".0"), F.col("q").cast("double")).alias("as_number"),
                       (F.col("budget_text") == "n/a").alias("kept_word"))


@query("unit_price", _d("""
    SELECT id, round(coalesce(budget / nullif(quantity, 0), 0), 4) AS unit_price FROM dirty_tenders"""))
def _(spark, sf_dir):
    return rounded(cleaning.add_unit_price(fx.dirty_tenders(spark, sf_dir), "budget").select("id", "unit_price"), 4)


@query("date_parts", _d(f"""
    SELECT id, CAST(year({_DATE}) AS integer) AS year, CAST(month({_DATE}) AS integer) AS month,
           CAST(day({_DATE}) AS integer) AS day FROM dirty_tenders"""))
def _(spark, sf_dir):
    return cleaning.add_date_parts(fx.dirty_tenders(spark, sf_dir), "date_text").select("id", "year", "month", "day")


@query("month_and_quarter", _d(f"""
    SELECT id, CAST(month({_DATE}) AS integer) AS month, CAST((month({_DATE}) - 1) // 3 + 1 AS integer) AS quarter,
           round(budget / 1000000, 8) AS budget_mln FROM dirty_tenders"""))
def _(spark, sf_dir):
    parsed = dates.as_timestamp("date_text")
    return rounded(fx.dirty_tenders(spark, sf_dir).select(
        "id", F.month(parsed).alias("month"), F.quarter(parsed).alias("quarter"),
        numbers.millions("budget").alias("budget_mln")), 8)


@query("clean_table", _d(f"""
    SELECT DISTINCT id, tender_no, organization, category, region, try_cast(budget_text AS double) AS budget_text,
           budget, quantity, strftime({_DATE}, '%Y-%m-%d') AS date_text
    FROM dirty_tenders WHERE {_COMPLETE}"""))
def _(spark, sf_dir):
    return as_text(batch_etl.clean(fx.dirty_tenders(spark, sf_dir)), date_text=DAY)


@query("etl_transform", fx.over("tenders", body="""
    SELECT id, category, region, organization, status, CAST(floor(budget) AS bigint) AS sum_value,
           CAST(id % 7 AS integer) AS quantity, round(coalesce(floor(budget) / nullif(id % 7, 0), 0), 4) AS unit_price,
           CAST(year(published_at) AS integer) AS year, CAST(month(published_at) AS integer) AS month,
           CAST(day(published_at) AS integer) AS day
    FROM tenders"""))
def _(spark, sf_dir):
    frame = batch_etl.as_etl_frame(fx.tenders(spark, sf_dir))
    return rounded(batch_etl.transform(frame.unionByName(frame)).drop("tender_name", "date"), 4)


@query("search_text", fx.over("dirty_tenders", body="""
    SELECT id, lower(concat_ws(' ', tender_no, organization, category, region)) AS search_text,
           CAST(length(tender_no) AS integer) AS number_length FROM dirty_tenders"""))
def _(spark, sf_dir):
    return fx.dirty_tenders(spark, sf_dir).select(
        "id", text.search_text("tender_no", "organization", "category", "region").alias("search_text"),
        F.length("tender_no").alias("number_length"))


@query("page_text", """
    SELECT page_id, md5(t) AS text_hash, CAST(length(t) AS integer) AS text_length FROM (
      SELECT page_id, replace(replace(replace(replace(replace(replace(
               regexp_replace(regexp_replace(html,
                 '(?is)<script.*?</script[^>]*>|<style.*?</style[^>]*>|<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g'),
               '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS t
      FROM pages) p""")
def _(spark, sf_dir):
    visible = fx.table(spark, sf_dir, "pages").select("page_id", text.strip_tags("html").alias("t"))
    return visible.select("page_id", F.md5("t").alias("text_hash"), F.length("t").alias("text_length"))


@query("epoch_seconds", fx.over("tenders", body="""
    SELECT id, CAST(epoch(published_at) AS bigint) AS seconds, printf('%.1f%%', 100 * budget / 500000) AS share
    FROM tenders"""))
def _(spark, sf_dir):
    utc = F.to_timestamp_ltz(F.concat(F.col("published_at").cast("string"), F.lit("+00:00")))
    return fx.tenders(spark, sf_dir).select("id", dates.epoch_seconds(utc).alias("seconds"),
                                            numbers.one_decimal(numbers.percent_of("budget", F.lit(500000)), "%").alias("share"))


@query("contract_cost", fx.over("procurements", body="""
    SELECT id, round(total_cost, 6) AS total_cost FROM procurements"""))
def _(spark, sf_dir):
    lines = fx.procurements(spark, sf_dir)
    return rounded(lines.select("id", numbers.contract_cost("quantity", "unit_price", "competitive_level")
                                .alias("total_cost")), 6)
