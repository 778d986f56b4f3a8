"""The tender tables derived from the test tables, as frames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.functions import text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical fact table: orders with customer, nation and region.

    No join hints: sizes decide, and a hot customer is split by the adaptive
    skew join.
    """
    return tenders_from(table(spark, sf_dir, "orders"), spark, sf_dir)


def tenders_from(orders: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    # The fact side streams through; every other side is a base table of known size.
    joined = (orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
              .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
              .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    return joined.select(
        F.col("o_orderkey").alias("id"),
        text.padded_number("o_orderkey").alias("tender_no"),
        F.col("c_name").alias("organization"),
        F.concat(F.lower("c_mktsegment"), F.lit(" supply "), F.lower("o_orderpriority")).alias("description"),
        F.col("c_mktsegment").alias("category"),
        F.col("n_name").alias("region"),
        F.col("o_totalprice").alias("budget"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("published_at"),
        F.col("r_name").alias("source"))


def dirty_tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values, bad numbers and dates, zero divisors, exact copies."""
    i = F.col("id")
    base = tenders(spark, sf_dir).select(
        "id", "tender_no", F.when(i % 97 != 0, F.col("organization")).alias("organization"), "category", "region",
        F.when(i % 53 == 0, F.lit(None)).when(i % 31 == 0, F.lit("n/a"))
        .otherwise(F.col("budget").cast("decimal(18,2)").cast("string")).alias("budget_text"),
        F.when(i % 53 != 0, F.col("budget")).alias("budget"),
        (i % 7).alias("quantity"),
        F.when(i % 29 == 0, F.lit("bad")).otherwise(F.to_date("published_at").cast("string")).alias("date_text"))
    # Copies come from one generator: the joins below run once.
    return base.withColumn("__copy", F.explode(F.when(i % 20 == 0, F.array(F.lit(1), F.lit(2)))
                                               .otherwise(F.array(F.lit(1))))).drop("__copy")


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed items with labelled HTML descriptions and four date spellings."""
    i, day, price = F.col("id"), F.col("published_at"), F.col("budget").cast("decimal(18,2)").cast("string")
    words = F.when(i % 5 == 0, "ремонт дорог").when(i % 5 == 1, "сервер и софт").when(i % 5 == 2, "школа") \
        .when(i % 5 == 3, "озеленение").otherwise("прочее")
    return tenders(spark, sf_dir).select(
        i.alias("item_id"), F.concat_ws(" ", "category", "region").alias("title"),
        F.concat(F.lit("https://example.org/view?registrationNumber="), i.cast("string"), F.lit("&tab=1")).alias("link"),
        F.concat(F.lit("<p>Заказчик: "), F.col("organization"), F.lit("</p>\n<p>Регион: "), F.col("region"),
                 F.lit("</p>\n"),
                 F.when(i % 41 == 0, F.lit("<p>без цены</p>"))
                 .otherwise(F.concat(F.lit("<p>Начальная цена: "), F.translate(price, ".", ","), F.lit("</p>"))),
                 F.lit("\n"), words).alias("description"),
        F.when(i % 4 == 0, F.concat(F.date_format(day, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0300")))
        .when(i % 4 == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(i % 4 == 2, F.date_format(day, "yyyy-MM-dd")).otherwise("soon").alias("published"))


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log derived from the events."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_id") % 3 == 0, "PROCESSING").otherwise("RAW").alias("stage"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("SUCCESS").alias("status"),
        F.floor("value").cast("bigint").alias("records_count"),
        F.col("ts").alias("logged_at"), F.col("event_type").alias("source"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two categories were loaded before, the pending tenders of them with other content."""
    loaded = tenders(spark, sf_dir).where(F.col("category").isin("BUILDING", "MACHINERY"))
    then = F.when(F.col("status") == "P", F.col("budget") + 1).otherwise(F.col("budget"))
    return loaded.select("tender_no", text.content_hash("tender_no", "description", then).alias("content_hash"),
                         F.col("published_at").alias("loaded_at"))


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed layer once the finished tenders are through; the dearest rows lost their reference."""
    return tenders(spark, sf_dir).where("status = 'F'").select(
        F.when(F.col("budget") <= 490_000, F.col("id")).alias("raw_id"), "tender_no", "category", "region", "budget",
        (F.col("budget") / 1_000_000).alias("budget_mln"), F.month("published_at").alias("month"),
        F.quarter("published_at").alias("quarter"))


def procurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table for the cost models: one row per order line."""
    lines = table(spark, sf_dir, "lineitem")
    t = tenders(spark, sf_dir).select(F.col("id").alias("tender_id"), "category", "region", "organization",
                                      "published_at")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    joined = lines.join(t, F.col("l_orderkey") == F.col("tender_id")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    level = (F.col("l_linenumber") % 4 + 1).cast("int")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "category", "region", "organization",
        F.col("l_linestatus").alias("status"), F.col("l_returnflag").alias("procurement_type"),
        F.col("l_quantity").alias("quantity"), price.alias("unit_price"),
        (F.col("p_size") / 10).alias("supplier_rating"),
        F.datediff("l_shipdate", "published_at").alias("contract_duration_days"),
        level.alias("competitive_level"), (F.col("l_discount") * 500).alias("advance_payment_pct"),
        (F.col("l_quantity") * price * (F.lit(0.5) + F.lit(0.5) * level / 4)).alias("total_cost"))


# --- the same tables for the SQL side -------------------------------------

SQL = {
    "tenders": """
        SELECT o.o_orderkey AS id,
               concat('44-', lpad(CAST(1000000 + o.o_orderkey AS string), 7, '0')) AS tender_no,
               c.c_name AS organization,
               concat(lower(c.c_mktsegment), ' supply ', lower(o.o_orderpriority)) AS description,
               c.c_mktsegment AS category, n.n_name AS region, o.o_totalprice AS budget,
               o.o_orderstatus AS status, o.o_orderdate AS published_at, r.r_name AS source
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "dirty_tenders": """
        SELECT b.* FROM (
          SELECT id, tender_no, CASE WHEN id % 97 = 0 THEN NULL ELSE organization END AS organization,
                 category, region,
                 CASE WHEN id % 53 = 0 THEN NULL WHEN id % 31 = 0 THEN 'n/a'
                      ELSE CAST(CAST(budget AS decimal(18,2)) AS string) END AS budget_text,
                 CASE WHEN id % 53 = 0 THEN NULL ELSE budget END AS budget,
                 id % 7 AS quantity,
                 CASE WHEN id % 29 = 0 THEN 'bad' ELSE CAST(CAST(published_at AS date) AS string) END AS date_text
          FROM tenders) b
        JOIN (SELECT 1 AS k UNION ALL SELECT 2) copies ON k = 1 OR id % 20 = 0""",
    "feed_items": """
        SELECT id AS item_id, concat(category, ' ', region) AS title,
               concat('https://example.org/view?registrationNumber=', CAST(id AS string), '&tab=1') AS link,
               concat('<p>Заказчик: ', organization, '</p>', chr(10), '<p>Регион: ', region, '</p>', chr(10),
                      CASE WHEN id % 41 = 0 THEN '<p>без цены</p>'
                           ELSE concat('<p>Начальная цена: ',
                                       replace(CAST(CAST(budget AS decimal(18,2)) AS string), '.', ','), '</p>') END,
                      chr(10),
                      CASE id % 5 WHEN 0 THEN 'ремонт дорог' WHEN 1 THEN 'сервер и софт'
                                  WHEN 2 THEN 'школа' WHEN 3 THEN 'озеленение' ELSE 'прочее' END) AS description,
               CASE id % 4 WHEN 0 THEN concat(strftime(published_at, '%a, %d %b %Y %H:%M:%S'), ' +0300')
                           WHEN 1 THEN strftime(published_at, '%Y-%m-%dT%H:%M:%S')
                           WHEN 2 THEN strftime(published_at, '%Y-%m-%d') ELSE 'soon' END AS published
        FROM tenders""",
    "load_log": """
        SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN 'PROCESSING' ELSE 'RAW' END AS stage,
               CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS status,
               CAST(floor(value) AS bigint) AS records_count, ts AS logged_at, event_type AS source
        FROM events""",
    "ledger": """
        SELECT tender_no,
               md5(concat(tender_no, description, CAST(CAST(CASE WHEN status = 'P' THEN budget + 1 ELSE budget END
                                                            AS decimal(20,2)) AS string))) AS content_hash,
               published_at AS loaded_at
        FROM tenders WHERE category IN ('BUILDING', 'MACHINERY')""",
    "processed": """
        SELECT CASE WHEN budget > 490000 THEN NULL ELSE id END AS raw_id, tender_no, category, region, budget,
               budget / 1000000 AS budget_mln, CAST(month(published_at) AS integer) AS month,
               CAST(quarter(published_at) AS integer) AS quarter
        FROM tenders WHERE status = 'F'""",
    "procurements": """
        SELECT l_orderkey * 10 + l_linenumber AS id, category, region, organization,
               l_linestatus AS status, l_returnflag AS procurement_type, l_quantity AS quantity,
               l_extendedprice / l_quantity AS unit_price, p_size / 10 AS supplier_rating,
               CAST(CAST(l_shipdate AS date) - CAST(published_at AS date) AS integer) AS contract_duration_days,
               l_linenumber % 4 + 1 AS competitive_level, l_discount * 500 AS advance_payment_pct,
               l_quantity * (l_extendedprice / l_quantity) * (0.5 + 0.5 * (l_linenumber % 4 + 1) / 4) AS total_cost
        FROM lineitem JOIN tenders t ON l_orderkey = t.id JOIN part ON l_partkey = p_partkey""",
}


# The five primes of XXH64.
XXH64_PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)


def uniform_sql(source: str, key: str, seed: int, name: str) -> str:
    """``source`` with the draw that ``numbers.stable_uniform`` makes of a non-negative long key: XXH64 in 128-bit numbers."""
    one, two, three, four, five = XXH64_PRIMES
    whole = 1 << 64

    def turned(x: str, bits: int) -> str:
        return f"((({x} << {bits}) | ({x} >> {64 - bits})) % {whole})"

    def spread(x: str, to: str) -> list[tuple[str, str]]:
        return [(f"{to}1", f"xor({x}, {x} >> 33) * {two} % {whole}"), (f"{to}2", f"xor({to}1, {to}1 >> 29) * {three} % {whole}"),
                (f"{to}3", f"xor({to}2, {to}2 >> 32)")]

    steps = [("k1", f"CAST({key} AS UHUGEINT) * {two} % {whole}"),
             ("k2", f"xor(CAST({42 + five + 8} AS UHUGEINT), {turned('k1', 31)} * {one} % {whole})"),
             ("k3", f"({turned('k2', 27)} * {one} + {four}) % {whole}"), *spread("k3", "x"),
             ("s1", f"xor((x3 + {five + 4}) % {whole}, CAST({seed * one % whole} AS UHUGEINT))"),
             ("s2", f"({turned('s1', 23)} * {two} + {three}) % {whole}"), *spread("s2", "y")]
    for column, value in steps:
        source = f"(SELECT *, {value} AS {column} FROM {source})"
    return (f"(SELECT * EXCLUDE ({', '.join(c for c, _ in steps)}), (CAST(y3 % {1 << 52} AS DOUBLE) + 0.5) / {1 << 52} AS {name} "
            f"FROM {source})")


def over(*names: str, body: str) -> str:
    """SQL text with the named derived tables in front (each may use the earlier ones)."""
    wanted = list(names)
    if "tenders" not in wanted and any("tenders" in SQL[n] for n in wanted):
        wanted.insert(0, "tenders")
    heads = ",\n".join(f"{n} AS ({SQL[n]})" for n in wanted)
    body = body.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {heads},\n{body[4:].lstrip()}"
    return f"WITH {heads}\n{body}"
