"""Maps the TPC-H-like test tables to the warehouse's staging shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import money

SALES_CALENDAR = ("1995-01-01", "2001-12-31")
EVENT_CALENDAR = ("2024-01-01", "2024-12-31")
FIRST_BATCH, SECOND_BATCH = "1995-01-01 00:00:00", "1998-01-01 00:00:00"
ORDER_TIES = ("l_shipdate", "l_partkey", "l_suppkey")
RUN_ID = "load-1"


# The schemas are known, so no job has to open files to infer them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _ts(text: str):
    return F.lit(text).cast("timestamp")


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; the order's id becomes text before the join, so the join's partitioning serves later steps, the product's after it.

    The part key crosses the exchange as a number among the ties anyway.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_line_number"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        money(F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
        money(F.col("l_extendedprice") * (1 - F.col("l_discount")) * F.col("l_tax")).alias("tax_amount"),
        *ORDER_TIES,
    )
    headers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_timestamp"),
    )
    joined = lines.join(headers, "order_id").withColumn("product_id", F.col("l_partkey").cast("string"))
    rest = [c for c in joined.columns if c not in ("order_id", "order_line_number", "product_id")]
    return joined.select("order_id", "order_line_number", "product_id", *rest)


def stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("raw_product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        money("p_retailprice").alias("unit_price"),
        money(F.col("p_retailprice") * 0.6).alias("cost_price"),
        _ts(FIRST_BATCH).alias("updated_at"),
    )


def stg_products_repriced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later batch: large parts cost more and move to another category."""
    return (
        stg_products(spark, sf_dir)
        .join(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("raw_product_id"), "p_size"), "raw_product_id")
        .filter("p_size >= 40")
        .withColumn("unit_price", (F.col("unit_price") + 10).cast("decimal(12,2)"))
        .withColumn("category", F.concat("category", F.lit(" LARGE")))
        .withColumn("updated_at", _ts(SECOND_BATCH))
        .drop("p_size")
    )


def stg_customers(spark: SparkSession, sf_dir: str, start: str = FIRST_BATCH) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    people = table(spark, sf_dir, "customer")
    return people.join(places, people.c_nationkey == places.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("raw_customer_id"),
        F.lit("Customer").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.col("c_name"), F.lit("@Example.com")).alias("email"),
        F.col("c_mktsegment").alias("customer_tier"),
        F.col("n_name").alias("city"),
        F.lit("").alias("state"),
        F.col("r_name").alias("country"),
        _ts(start).alias("updated_at"),
        "c_acctbal",
    )


def customer_batches(spark: SparkSession, sf_dir: str, start: str = FIRST_BATCH) -> list[DataFrame]:
    """All customers, then those with a low balance under a new tier."""
    everyone = stg_customers(spark, sf_dir, start)
    moved = everyone.filter("c_acctbal < 3000").withColumns(
        {"customer_tier": F.concat("customer_tier", F.lit(" BASIC")), "updated_at": _ts(SECOND_BATCH)}
    )
    return [everyone.drop("c_acctbal"), moved.drop("c_acctbal")]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def raw_stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per event type."""
    at = F.struct("ts", "event_id")
    return (
        _events(spark, sf_dir)
        .groupBy(F.upper("event_type").alias("ticker"), F.to_date("ts").alias("trade_date"))
        .agg(
            F.min_by("value", at).alias("open_price"), F.max("value").alias("high_price"), F.min("value").alias("low_price"),
            F.max_by("value", at).alias("close_price"), F.count(F.lit(1)).alias("volume"), F.min("ts").alias("ingested_at"),
        )
        .withColumns({"source": F.lit("events"), "pipeline_run_id": F.lit(RUN_ID)})
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations per user: temperature is the event value, the condition its type."""
    value, k = F.col("value"), F.get_json_object("props", "$.k").cast("int")
    return _events(spark, sf_dir).select(
        F.concat(F.lit("city-"), F.col("user_id").cast("string")).alias("city"),
        F.lit("XX").alias("country_code"),
        F.col("ts").alias("observation_dt"),
        value.alias("temp_celsius"),
        value.alias("feels_like_c"),
        (value - 2.0).alias("temp_min_c"),
        (value + 2.0).alias("temp_max_c"),
        F.lit(1013).alias("pressure_hpa"),
        k.alias("humidity_pct"),
        F.lit(5.0).alias("wind_speed_ms"),
        F.lit(0).alias("wind_deg"),
        F.lit(0).alias("clouds_pct"),
        F.col("event_type").alias("weather_main"),
        F.col("event_type").alias("weather_desc"),
        F.lit(10000).alias("visibility_m"),
        F.when(F.col("event_type") == "error", value).alias("rain_1h_mm"),
        F.lit(None).cast("double").alias("snow_1h_mm"),
        F.col("user_id").cast("double").alias("latitude"),
        (-F.col("user_id")).cast("double").alias("longitude"),
        F.lit("events").alias("source"),
        F.col("ts").alias("ingested_at"),
        F.lit(RUN_ID).alias("pipeline_run_id"),
    )


def raw_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per document; the whole text is the content, its first line the title."""
    published = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 3607 % 2592000)
    return table(spark, sf_dir, "documents").select(
        F.lit("").alias("source_id"),
        F.concat(F.lit("Source "), F.col("source")).alias("source_name"),
        F.lit(None).cast("string").alias("author"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.lit("").alias("description"),
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("n_chars") > 1000, F.lit("image")).alias("url_to_image"),
        published.alias("published_at"),
        F.col("text").alias("content"),
        F.col("lang").alias("topic"),
        F.lit("documents").alias("source_api"),
        published.alias("ingested_at"),
        F.lit(RUN_ID).alias("pipeline_run_id"),
    )


def stg_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return e.select(
        F.concat(F.lit("FIN-"), F.col("event_id").cast("string")).alias("raw_id"),
        money("value").alias("amount"),
        F.col("event_type").alias("category_name"),
        F.when(F.col("event_type") == "purchase", F.lit("Income")).alias("category_type"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("merchant"),
        F.to_date("ts").alias("transaction_date"),
        F.col("props").alias("notes"),
        F.col("ts").alias("ingested_at"),
    )


def stg_fitness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return e.select(
        F.concat(F.lit("FIT-"), F.col("event_id").cast("string")).alias("raw_id"),
        F.col("event_type").alias("workout_name"),
        F.when(F.col("event_type") == "signup", F.lit("Strength")).alias("workout_category"),
        F.floor("value").cast("int").alias("duration_minutes"),
        F.get_json_object("props", "$.k").cast("int").alias("calories_burned"),
        F.to_date("ts").alias("workout_date"),
        F.lit("Moderate").alias("intensity"),
        F.col("ts").alias("ingested_at"),
    )


def stg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log entry per conversation turn; the rating follows the text length."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.concat(F.lit("MED-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("raw_id"),
        F.concat(F.lit("conversation "), F.col("conv_id").cast("string")).alias("title"),
        F.col("role").alias("media_type"),
        F.lit("chat").alias("genre"),
        F.col("role").alias("creator"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int")).alias("consumed_date"),
        ((F.length("text") % 110) / 10.0).alias("rating"),
        F.lit(None).cast("string").alias("notes"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("turn")).alias("ingested_at"),
    )
