"""Every scalar function over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numbers as N
from ..functions import text as X
from ..plans import bindings as B
from ..plans.calendar import core_date_dim, date_dim
from . import sql as S
from .core import query


@query("text_functions", """
SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand,
  replace(p_name, ' ', '_') AS replaced, CAST(length(p_name) AS BIGINT) AS name_length,
  CAST(length(trim(p_name)) - length(replace(trim(p_name), ' ', '')) + 1 AS BIGINT) AS words, p_brand || ' ' || p_name AS label,
  lpad(CAST(p_size AS VARCHAR), 2, '0') AS padded_size, substring(p_name, 1, 5) AS prefix, lower(replace(p_brand, ' ', '-')) AS slug,
  CAST(len(list_distinct(string_split(lower(p_name), ' '))) AS BIGINT) AS tokens,
  CAST(len(list_intersect(string_split(lower(p_name), ' '), ['red', 'ring', 'steel'])) AS BIGINT) AS hits FROM part""")
def text_functions(spark, sf_dir) -> DataFrame:
    p = B.table(spark, sf_dir, "part")
    return p.select(
        "p_partkey", F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"), F.upper("p_name").alias("upper_name"),
        F.lower("p_brand").alias("lower_brand"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("replaced"),
        F.length("p_name").alias("name_length"), X.word_count("p_name").alias("words"), X.full_name("p_brand", "p_name").alias("label"),
        F.lpad(F.col("p_size").cast("string"), 2, "0").alias("padded_size"), X.prefix("p_name", 5).alias("prefix"),
        X.slug("p_brand").alias("slug"), F.size(X.token_set("p_name")).alias("tokens"),
        X.matches(X.token_set("p_name"), ["red", "ring", "steel"]).alias("hits"),
    )


@query("null_functions", f"""
SELECT c_custkey, COALESCE(NULLIF(c_mktsegment, 'MACHINERY'), 'none') AS segment,
  CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal BETWEEN 0 AND 1000 THEN 'low' ELSE 'high' END AS balance_class,
  c_mktsegment IN ('BUILDING', 'FURNITURE') AS listed, NULLIF(c_mktsegment, 'MACHINERY') IS NULL AS is_missing,
  CASE WHEN c_mktsegment NOT IN ('HOUSEHOLD') THEN c_mktsegment END AS usable, c_mktsegment <> 'MACHINERY' AS has_key FROM customer""")
def null_functions(spark, sf_dir) -> DataFrame:
    c = B.table(spark, sf_dir, "customer")
    segment = F.nullif("c_mktsegment", F.lit("MACHINERY"))
    return c.select(
        "c_custkey", F.coalesce(segment, F.lit("none")).alias("segment"),
        F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal").between(0, 1000), "low").otherwise("high").alias("balance_class"),
        F.col("c_mktsegment").isin("BUILDING", "FURNITURE").alias("listed"), segment.isNull().alias("is_missing"),
        X.null_tokens_to_null("c_mktsegment", ["HOUSEHOLD"]).alias("usable"),
        X.has_key(F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(" NaN ")).otherwise(F.col("c_mktsegment"))).alias("has_key"),
    )


@query("date_functions", f"""
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key, strftime(o_orderdate, '%A') AS day_name,
  strftime(o_orderdate, '%B') AS month_name, strftime(o_orderdate, '%Y-%m') AS month_label, {S.big('EXTRACT(DOW FROM o_orderdate) + 1')} AS sunday_first,
  {S.big('EXTRACT(ISODOW FROM o_orderdate)')} AS monday_first, {S.big('EXTRACT(DAY FROM o_orderdate)')} AS dom,
  {S.big('EXTRACT(DOY FROM o_orderdate)')} AS doy, {S.big('EXTRACT(WEEK FROM o_orderdate)')} AS iso_week,
  {S.big('EXTRACT(QUARTER FROM o_orderdate)')} AS quarter, {S.big('EXTRACT(HOUR FROM o_orderdate)')} AS hour,
  EXTRACT(ISODOW FROM o_orderdate) IN (6, 7) AS weekend, EXTRACT(DAY FROM o_orderdate) = 1 AS month_start,
  CAST(o_orderdate AS DATE) = last_day(o_orderdate) AS month_end,
  {S.big('CASE WHEN EXTRACT(MONTH FROM o_orderdate) >= 4 THEN EXTRACT(QUARTER FROM o_orderdate) - 1 ELSE 4 END')} AS fiscal_quarter,
  {S.big('CASE WHEN EXTRACT(MONTH FROM o_orderdate) >= 4 THEN EXTRACT(YEAR FROM o_orderdate) ELSE EXTRACT(YEAR FROM o_orderdate) - 1 END')} AS fiscal_year,
  {S.big("datediff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31')")} AS days_left,
  strftime(CAST(date_trunc('month', o_orderdate) AS DATE) + INTERVAL 3 MONTH, '%Y-%m') AS in_three_months,
  strftime(CAST(o_orderdate AS DATE) + CAST(CASE EXTRACT(ISODOW FROM o_orderdate) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS INTEGER), '%Y-%m-%d') AS next_weekday,
  strftime(make_timestamp(o_orderkey * 1000000), '%Y-%m-%d %H:%M:%S') AS from_epoch,
  {S.instant('o_orderdate')} AS from_iso FROM orders""")
def date_functions(spark, sf_dir) -> DataFrame:
    o = B.table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    return o.select(
        "o_orderkey", D.date_key(d).alias("date_key"), D.day_name(d).alias("day_name"), D.month_name(d).alias("month_name"),
        D.month_label(d).alias("month_label"), D.day_of_week(d, "sunday").alias("sunday_first"), D.day_of_week(d).alias("monday_first"),
        F.dayofmonth(d).alias("dom"), F.dayofyear(d).alias("doy"), F.weekofyear(d).alias("iso_week"), F.quarter(d).alias("quarter"),
        F.hour(d).alias("hour"), D.is_weekend(d).alias("weekend"), D.is_month_start(d).alias("month_start"),
        D.is_month_end(F.to_date(d)).alias("month_end"), D.fiscal_quarter(d).alias("fiscal_quarter"), D.fiscal_year(d).alias("fiscal_year"),
        F.datediff(F.lit("2001-12-31").cast("date"), d).alias("days_left"), D.months_after(D.month_label(d), F.lit(3)).alias("in_three_months"),
        F.element_at(D.next_weekdays(F.to_date(d), 1), 1).alias("next_weekday"), F.timestamp_seconds("o_orderkey").alias("from_epoch"),
        D.parse_instant(F.concat(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).alias("from_iso"),
    )


@query("number_functions", f"""
SELECT o_orderkey, {S.rounded('o_totalprice / 7', 2)} AS rounded, {S.percent('o_totalprice', 'o_orderkey')} AS ratio_pct,
  GREATEST(1000.0::DOUBLE, LEAST(200000.0::DOUBLE, o_totalprice)) AS clamped, abs(o_totalprice - 100000) AS distance,
  {S.rounded('sqrt(o_totalprice)', 4)} AS root, CAST(trunc(o_totalprice) AS BIGINT) AS whole, CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) AS text_key,
  TRY_CAST(o_orderpriority AS BIGINT) AS bad_cast, CAST(o_custkey % 12 AS BIGINT) AS remainder FROM orders""")
def number_functions(spark, sf_dir) -> DataFrame:
    o = B.table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    return o.select(
        "o_orderkey", N.round_half_up(price / 7, 2).alias("rounded"), N.percent(price, "o_orderkey").alias("ratio_pct"),
        N.clamp(price, 1000.0, 200000.0).alias("clamped"), F.abs(price - 100000).alias("distance"),
        N.round_half_up(F.sqrt(price), 4).alias("root"), N.truncate_to_int(price).alias("whole"),
        F.col("o_orderkey").cast("string").cast("bigint").alias("text_key"), F.col("o_orderpriority").try_cast("bigint").alias("bad_cast"),
        (F.col("o_custkey") % 12).alias("remainder"),
    )


@query("json_functions", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, COALESCE(json_extract_string(props, '$.missing.path'), 'none') AS missing,
  '{"id":' || CAST(event_id AS VARCHAR) || ',"type":"' || event_type || '"}' AS encoded FROM events""")
def json_functions(spark, sf_dir) -> DataFrame:
    """JSON path with default, JSON encoding."""
    e = B.table(spark, sf_dir, "events")
    parsed = F.from_json("props", "k bigint, missing struct<path:string>")
    return e.select(
        "event_id", parsed["k"].alias("k"), F.coalesce(parsed["missing"]["path"], F.lit("none")).alias("missing"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("encoded"),
    )


@query("record_ids", """
SELECT event_id, 'EVT-' || upper(sha256(CAST(event_id AS VARCHAR) || chr(1) || event_type)) AS natural_id, CAST(36 AS BIGINT) AS uuid_length FROM events""")
def record_ids(spark, sf_dir) -> DataFrame:
    """Ids from the natural key, and random ids (only their length is comparable)."""
    e = B.table(spark, sf_dir, "events")
    return e.select("event_id", X.prefixed_id("EVT", "event_id", "event_type").alias("natural_id"), F.length(X.random_id()).alias("uuid_length"))


_DATE_DIM = f"""
SELECT {S.big("strftime(d, '%Y%m%d')")} AS date_key, {S.day('d')} AS full_date, strftime(d, '%A') AS day_name,
  {S.big('EXTRACT(ISODOW FROM d)')} AS day_of_week, {S.big('EXTRACT(DAY FROM d)')} AS day_of_month, {S.big('EXTRACT(DOY FROM d)')} AS day_of_year,
  {S.big('EXTRACT(WEEK FROM d)')} AS week_of_year, {S.big('EXTRACT(MONTH FROM d)')} AS month, strftime(d, '%B') AS month_name,
  {S.big('EXTRACT(QUARTER FROM d)')} AS quarter, {S.big('EXTRACT(YEAR FROM d)')} AS year, EXTRACT(ISODOW FROM d) IN (6, 7) AS is_weekend,
  EXTRACT(DAY FROM d) = 1 AS is_month_start, CAST(d AS DATE) = last_day(d) AS is_month_end,
  {S.big('CASE WHEN EXTRACT(MONTH FROM d) >= 4 THEN EXTRACT(QUARTER FROM d) - 1 ELSE 4 END')} AS fiscal_quarter,
  {S.big('CASE WHEN EXTRACT(MONTH FROM d) >= 4 THEN EXTRACT(YEAR FROM d) ELSE EXTRACT(YEAR FROM d) - 1 END')} AS fiscal_year, n AS orders
FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) AS s(d)
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, COUNT(*) AS n FROM orders GROUP BY 1) AS o ON o.od = CAST(d AS DATE)"""


@query("date_dim", _DATE_DIM)
def date_dim_query(spark, sf_dir) -> DataFrame:
    """Sixteen-column calendar, with the number of orders per day."""
    per_day = B.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("full_date")).agg(F.count(F.lit(1)).alias("orders"))
    return date_dim(spark, *B.SALES_CALENDAR).join(per_day, "full_date", "left")


@query("core_date_dim", f"""
SELECT {S.big("strftime(d, '%Y%m%d')")} AS date_key, {S.day('d')} AS full_date, strftime(d, '%A') AS day_name,
  {S.big('EXTRACT(DOW FROM d) + 1')} AS day_of_week, {S.big('EXTRACT(DAY FROM d)')} AS day_of_month, {S.big('EXTRACT(MONTH FROM d)')} AS month,
  strftime(d, '%B') AS month_name, {S.big('EXTRACT(QUARTER FROM d)')} AS quarter, {S.big('EXTRACT(YEAR FROM d)')} AS year,
  EXTRACT(DOW FROM d) IN (0, 6) AS is_weekend, n AS events
FROM generate_series(DATE '2024-01-01', DATE '2026-12-31', INTERVAL 1 DAY) AS s(d)
LEFT JOIN (SELECT CAST(ts AS DATE) AS od, COUNT(*) AS n FROM events GROUP BY 1) AS o ON o.od = CAST(d AS DATE)""")
def core_date_dim_query(spark, sf_dir) -> DataFrame:
    """Ten-column calendar with Sunday as day 1, with the number of events per day."""
    per_day = B.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("full_date")).agg(F.count(F.lit(1)).alias("events"))
    return core_date_dim(spark).join(per_day, "full_date", "left")
