"""Staging: cleaning, routing, rejects, measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key, month_label, month_label_from_key
from ..functions.numbers import sum_money
from ..operators.clean import (
    clean_customers, clean_orders, clean_products, distinct_projection, finance_reject_rules, fitness_reject_rules,
    media_reject_rules, normalise_headers, order_reject_rules, route, split_rejects, stage_customers, stage_news, stage_orders,
    stage_products, stage_stocks, stage_weather, with_reject_reason,
)
from ..operators.keys import dedupe_latest
from ..operators.measures import by_value, sales_measures
from ..operators.profile import batch_profile, resum, value_counts
from ..operators.ranking import top_per_key
from ..plans import bindings as B
from . import sql as S
from .core import query


def dirty_customers(spark, sf_dir) -> DataFrame:
    """Padded, upper-cased, blank and repeated customer records."""
    c = B.table(spark, sf_dir, "customer")
    nation = B.table(spark, sf_dir, "nation")
    base = c.join(nation, c.c_nationkey == nation.n_nationkey)
    lost = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 0)
    first = base.select(
        F.when(lost, F.lit("  ")).otherwise(F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit(" "))).alias("raw_customer_id"),
        F.lit(" Customer ").alias("first_name"),
        F.concat("c_name", F.lit("  ")).alias("last_name"),
        F.concat(F.upper("c_name"), F.lit("@Example.COM ")).alias("email"),
        F.when(F.col("c_acctbal") < 0, F.lit(" ")).otherwise(F.col("c_mktsegment")).alias("customer_tier"),
        F.concat(F.lit(" "), "n_name").alias("city"),
        F.lit("").alias("state"),
        F.lit(None).cast("string").alias("country"),
        F.when(F.col("c_acctbal") < 5000, F.lit("1995-01-01 00:00:00").cast("timestamp")).alias("updated_at"),
        "c_acctbal",
    )
    later = first.filter("c_acctbal >= 2000").withColumns(
        {"customer_tier": F.lit("Gold"), "updated_at": F.lit("1996-06-01 00:00:00").cast("timestamp")}
    )
    return first.unionByName(later).drop("c_acctbal")


@query("clean_customers", f"""
WITH base AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE NOT (c_mktsegment = 'MACHINERY' AND c_acctbal < 0)),
rows AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS last_name, lower(c_name) || '@example.com' AS email,
    CASE WHEN c_acctbal < 0 THEN 'Standard' ELSE c_mktsegment END AS customer_tier, n_name AS city,
    CASE WHEN c_acctbal < 5000 THEN TIMESTAMP '1995-01-01' ELSE TIMESTAMP '1995-12-31' END AS updated_at FROM base
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, lower(c_name) || '@example.com', 'Gold', n_name, TIMESTAMP '1996-06-01'
  FROM base WHERE c_acctbal >= 2000)
SELECT customer_id, 'Customer' AS first_name, last_name, email, customer_tier, city, '' AS state, CAST(NULL AS VARCHAR) AS country,
  {S.instant('updated_at')} AS updated_at
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) AS rn FROM rows) AS r WHERE rn = 1""")
def clean_customers_query(spark, sf_dir) -> DataFrame:
    return clean_customers(dirty_customers(spark, sf_dir), F.lit("1995-12-31 00:00:00").cast("timestamp"))


@query("clean_products", f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
  CASE WHEN p_type = 'ECONOMY' THEN 'Unassigned' ELSE p_type END AS category,
  CASE WHEN p_size < 10 THEN 'General' ELSE p_brand END AS subcategory,
  CASE WHEN p_size > 45 THEN 0.0 ELSE CAST({S.money('p_retailprice')} AS DOUBLE) END AS unit_price,
  CAST({S.money('p_retailprice * CAST(0.6 AS DOUBLE)')} AS DOUBLE) AS cost_price, '1997-01-01 00:00:00' AS updated_at
FROM part""")
def clean_products_query(spark, sf_dir) -> DataFrame:
    """Padded names, blank categories, missing prices and an older copy of every product."""
    p = B.table(spark, sf_dir, "part")
    dirty = p.select(
        F.concat(F.lit(" "), F.col("p_partkey").cast("string")).alias("raw_product_id"),
        F.concat(F.lit("  "), "p_name", F.lit("  ")).alias("product_name"),
        F.when(F.col("p_type") == "ECONOMY", F.lit("  ")).otherwise(F.col("p_type")).alias("category"),
        F.when(F.col("p_size") < 10, F.lit(None)).otherwise(F.col("p_brand")).alias("subcategory"),
        F.when(F.col("p_size") <= 45, B.money("p_retailprice")).alias("unit_price"),
        B.money(F.col("p_retailprice") * 0.6).alias("cost_price"),
        F.lit("1997-01-01 00:00:00").cast("timestamp").alias("updated_at"),
    )
    older = dirty.withColumns({"product_name": F.lit("old"), "updated_at": F.lit("1996-01-01 00:00:00").cast("timestamp")})
    return clean_products(dirty.unionByName(older))


def dirty_orders(spark, sf_dir) -> DataFrame:
    """Order lines with padded ids, blank or missing keys, bad quantities and missing amounts."""
    stg = B.stg_orders(spark, sf_dir)
    flags = F.col("quantity")
    return stg.withColumns(
        {
            "order_id": F.concat(F.lit(" "), "order_id", F.lit(" ")),
            "product_id": F.when(flags == 13, F.lit("nan")).when(flags == 14, F.lit("  ")).otherwise(F.col("product_id")),
            "customer_id": F.when(flags == 15, F.lit(None)).otherwise(F.col("customer_id")),
            "quantity": F.when(flags == 1, F.lit(-5)).when(flags == 2, F.lit(None)).otherwise(flags),
            "discount_amount": F.when(F.col("discount_amount") > 0, F.col("discount_amount")),
            "tax_amount": F.when(F.col("tax_amount") > 0, F.col("tax_amount")),
        }
    )


@query("dedupe_orders", S.with_(S.STG_ORDERS, S.CLEAN_ORDERS, select=f"""
SELECT order_id, {S.big('order_line_number')} AS order_line_number, customer_id, product_id, {S.instant('order_timestamp')} AS order_timestamp,
  {S.big('quantity')} AS quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_amount AS DOUBLE) AS discount_amount,
  CAST(tax_amount AS DOUBLE) AS tax_amount FROM clean_orders"""))
def dedupe_orders(spark, sf_dir) -> DataFrame:
    return clean_orders(B.stg_orders(spark, sf_dir), B.ORDER_TIES, ids_trimmed=True)


@query("clean_orders", S.with_(S.STG_ORDERS, """good AS (
  SELECT * FROM stg_orders WHERE quantity NOT IN (1, 2, 14, 15))""", S.CLEAN_ORDERS.replace("FROM stg_orders", "FROM good"), select=f"""
SELECT order_id, {S.big('order_line_number')} AS order_line_number, customer_id,
  CASE WHEN quantity = 13 THEN 'nan' ELSE product_id END AS product_id, {S.instant('order_timestamp')} AS order_timestamp,
  {S.big('quantity')} AS quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_amount AS DOUBLE) AS discount_amount,
  CAST(tax_amount AS DOUBLE) AS tax_amount FROM clean_orders"""))
def clean_orders_query(spark, sf_dir) -> DataFrame:
    return clean_orders(dirty_orders(spark, sf_dir), B.ORDER_TIES)


_REASON = """CASE WHEN quantity IN (13, 14) THEN 'invalid product_id' WHEN quantity = 15 THEN 'invalid customer_id'
    WHEN quantity IN (1, 2) THEN 'invalid quantity' END"""


@query("reject_log", S.with_(S.STG_ORDERS, select=f"""
SELECT order_id, {S.big('order_line_number')} AS order_line_number, {_REASON} AS reject_reason, COUNT(*) AS n
FROM stg_orders WHERE quantity IN (1, 2, 13, 14, 15) GROUP BY 1, 2, 3"""))
def reject_log_query(spark, sf_dir) -> DataFrame:
    """Rejected order lines with their reason."""
    _, rejects = split_rejects(dirty_orders(spark, sf_dir), order_reject_rules())
    return rejects.groupBy(F.trim("order_id").alias("order_id"), "order_line_number", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query("reject_summary", S.with_(S.STG_ORDERS, select=f"""
SELECT COALESCE({_REASON}, 'accepted') AS outcome, COUNT(*) AS n FROM stg_orders GROUP BY 1"""))
def reject_summary(spark, sf_dir) -> DataFrame:
    judged = with_reject_reason(dirty_orders(spark, sf_dir), order_reject_rules())
    return judged.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("personal_rejects", """
SELECT 'fitness' AS domain, 'duration_minutes not positive' AS reject_reason, COUNT(*) AS n FROM events WHERE floor(value) <= 0
UNION ALL SELECT 'media', 'rating outside 0..10', COUNT(*) FROM conversations WHERE length(text) % 110 > 100
UNION ALL SELECT 'finance', 'missing merchant', COUNT(*) FROM events WHERE event_type = 'error'""")
def personal_rejects(spark, sf_dir) -> DataFrame:
    """Value-range rules of the finance, fitness and media records."""
    finance = B.stg_finance(spark, sf_dir).withColumn("merchant", F.when(F.col("category_name") != "error", F.col("merchant")))
    parts = [
        ("fitness", B.stg_fitness(spark, sf_dir), fitness_reject_rules()),
        ("media", B.stg_media(spark, sf_dir), media_reject_rules()),
        ("finance", finance, finance_reject_rules()),
    ]
    counted = [
        split_rejects(df, rules)[1].groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("domain"), "reject_reason", "n")
        for name, df, rules in parts
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def mixed_batch(spark, sf_dir) -> DataFrame:
    """One upload whose headers describe observations, bars and articles at once."""
    e = B.table(spark, sf_dir, "events")
    return e.select(
        F.when(F.col("event_type") == "error", F.lit("NaN")).otherwise(F.col("event_type")).alias(" City "),
        F.col("value").cast("string").alias("Temperature"),
        F.when(F.col("event_type") == "click", F.lit(" ")).otherwise(F.col("event_type")).alias("Symbol"),
        F.col("value").cast("string").alias("OPEN"),
        F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("event_type")).alias("headline"),
        F.col("event_type").alias("Category"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"),
    )


@query("routed_batch", f"""
SELECT 'weather' AS domain, event_type AS member, COUNT(*) AS n, {S.total('CAST(value AS DECIMAL(18,2))')} AS total, {S.total('CAST(value + 2.0 AS DECIMAL(18,4))')} AS derived
FROM events WHERE event_type <> 'error' GROUP BY 2
UNION ALL SELECT 'stocks', upper(event_type), COUNT(*), {S.total('CAST(value AS DECIMAL(18,2))')}, {S.total('CAST(value * 1.02::DOUBLE AS DECIMAL(18,4))')}
FROM events WHERE event_type <> 'click' GROUP BY 2
UNION ALL SELECT 'news', event_type, COUNT(*), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM events WHERE event_type <> 'view' GROUP BY 2""")
def routed_batch(spark, sf_dir) -> DataFrame:
    """Header normalisation, routing by columns, alias resolution, derived defaults, key filter."""
    parts = route(mixed_batch(spark, sf_dir))
    weather = stage_weather(parts["weather"])
    stocks = stage_stocks(parts["stocks"])
    news = stage_news(parts["news"])

    def summed(df, name, member, value, derived):
        return df.groupBy(member.alias("member")).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(value.cast("decimal(18,2)")).cast("double").alias("total"),
            F.sum(derived.cast("decimal(18,4)")).cast("double").alias("derived"),
        ).select(F.lit(name).alias("domain"), "member", "n", "total", "derived")

    zero = F.lit(0)
    return (
        summed(weather, "weather", F.col("city"), F.col("temp_celsius"), F.col("temp_max_c"))
        .unionByName(summed(stocks, "stocks", F.col("ticker"), F.col("open_price"), F.col("high_price")))
        .unionByName(summed(news, "news", F.col("title"), zero, zero))
    )


@query("routed_order_batch", S.with_(S.STG_ORDERS, """u AS (
  SELECT * FROM stg_orders AS s JOIN part ON p_partkey = s.l_partkey)""", select=f"""
SELECT 'orders' AS part, COUNT(*) AS n, {S.total('unit_price')} AS total FROM u
UNION ALL SELECT 'customers', COUNT(DISTINCT customer_id), CAST(0 AS DOUBLE) FROM u
UNION ALL SELECT 'products', COUNT(*), {S.total('unit_price')} FROM (SELECT DISTINCT product_id, p_name, unit_price FROM u) AS d"""))
def routed_order_batch(spark, sf_dir) -> DataFrame:
    """One mixed upload split into order lines and distinct customer and product records."""
    part = B.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("Product_Name"))
    upload = B.stg_orders(spark, sf_dir).join(part, "l_partkey")
    parts = route(normalise_headers(upload))
    zero = F.lit(0.0)
    sides = [
        ("orders", stage_orders(parts["orders"]), sum_money("unit_price")),
        ("customers", stage_customers(parts["customers"]), F.max(zero)),
        ("products", stage_products(parts["products"]), sum_money("unit_price")),
    ]
    frames = [
        df.agg(F.count(F.lit(1)).alias("n"), total.alias("total")).select(F.lit(name).alias("part"), "n", "total") for name, df, total in sides
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("distinct_projection", """SELECT DISTINCT event_type, user_id FROM events""")
def distinct_projection_query(spark, sf_dir) -> DataFrame:
    return distinct_projection(B.table(spark, sf_dir, "events"), ["event_type", "user_id", "not_there"])


@query("sales_measures", S.with_(S.STG_ORDERS, S.CLEAN_ORDERS, S.DIM_PRODUCT, "versioned AS (SELECT * FROM clean_orders)", S.measures("zero"), select=f"""
SELECT order_id, {S.big('order_line_number')} AS order_line_number, {S.big('order_date_key')} AS order_date_key,
  strftime(order_timestamp, '%Y-%m') AS order_month, CAST(gross_amount AS DOUBLE) AS gross_amount, CAST(net_amount AS DOUBLE) AS net_amount,
  CAST(cost_amount AS DOUBLE) AS cost_amount, CAST(profit_amount AS DOUBLE) AS profit_amount, profit_margin_pct FROM fact_sales"""))
def sales_measures_query(spark, sf_dir) -> DataFrame:
    """Gross to margin for every order line, with the 0-margin rule; date key and month label."""
    orders = clean_orders(B.stg_orders(spark, sf_dir), B.ORDER_TIES, ids_trimmed=True)
    cost = clean_products(B.stg_products(spark, sf_dir)).select("product_id", "cost_price")
    measured = sales_measures(orders.join(cost, "product_id"), "zero").withColumn("order_date_key", date_key("order_timestamp"))
    return measured.select(
        "order_id", "order_line_number", "order_date_key", month_label_from_key("order_date_key").alias("order_month"),
        "gross_amount", "net_amount", "cost_amount", "profit_amount", "profit_margin_pct",
    )


@query("filter_by_value", """
SELECT strftime(o_orderdate, '%Y-%m') AS period, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1""")
def filter_by_value(spark, sf_dir) -> DataFrame:
    """One dimension value or all of them, then a roll-up by period."""
    orders = by_value(by_value(B.table(spark, sf_dir, "orders"), "o_orderpriority", "1-URGENT"), "o_orderstatus", "All")
    monthly = orders.withColumn("period", month_label("o_orderdate")).withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    return resum(monthly, ["period"], "price", "total")


@query("status_counts", "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1")
def status_counts(spark, sf_dir) -> DataFrame:
    return value_counts(B.table(spark, sf_dir, "orders"), "o_orderstatus")


@query("batch_profile", """
SELECT COUNT(*) AS total_rows, CAST(9 AS BIGINT) AS total_columns,
  COUNT(*) + COUNT(*) FILTER (WHERE c_acctbal >= 5000 AND first) AS missing_values
FROM (SELECT c_acctbal, c_mktsegment, TRUE AS first FROM customer UNION ALL SELECT c_acctbal, c_mktsegment, FALSE FROM customer WHERE c_acctbal >= 2000) AS u""")
def batch_profile_query(spark, sf_dir) -> DataFrame:
    """Rows, columns and missing cells (country always, update time sometimes)."""
    return batch_profile(dirty_customers(spark, sf_dir))


@query("newest_events_per_user", """
SELECT event_id, user_id, event_type FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS r WHERE rn <= 30""")
def newest_events_per_user(spark, sf_dir) -> DataFrame:
    """The newest 30 rows of every key."""
    events = B.table(spark, sf_dir, "events")
    return top_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 30).select("event_id", "user_id", "event_type")


@query("latest_event_per_user", """
SELECT event_id, user_id, event_type FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS r WHERE rn = 1""")
def latest_event_per_user(spark, sf_dir) -> DataFrame:
    events = B.table(spark, sf_dir, "events")
    return dedupe_latest(events, ["user_id"], ["ts"], ["event_id"]).select("event_id", "user_id", "event_type")
