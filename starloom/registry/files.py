"""Files, payloads and table-store operations, written from the test tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import sum_money
from ..operators.measures import eligible_bars
from ..plans import bindings as B
from ..session import scratch_path
from ..sources import payloads
from ..sources.files import append_staging, read_csv, read_external_csv, write_clustered, write_csv
from ..sources.sinks import PREVIEW_TABLES, preview, publish_layer, purge, replicate
from ..sources.store import TableStore
from . import sql as S
from .core import query
from .reports import sales

_PRODUCT_CSV = "raw_product_id string, product_name string, category string, subcategory string, unit_price decimal(12,2), cost_price decimal(12,2), updated_at timestamp"


@query("csv_staging_load", f"""
SELECT CAST(p_partkey AS VARCHAR) AS raw_product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory,
  CAST({S.money('p_retailprice')} AS DOUBLE) AS unit_price, CAST({S.money('p_retailprice * CAST(0.6 AS DOUBLE)')} AS DOUBLE) AS cost_price,
  '1995-01-01 00:00:00' AS updated_at, CAST(2 AS BIGINT) AS copies FROM part""")
def csv_staging_load(spark, sf_dir) -> DataFrame:
    """Export to CSV, load typed, append to staging twice: staging keeps both copies."""
    root = scratch_path(spark, "csv")
    write_csv(B.stg_products(spark, sf_dir), f"{root}/export")
    good, _ = read_csv(spark, f"{root}/export", _PRODUCT_CSV)
    append_staging(good, f"{root}/stg_products")
    append_staging(good, f"{root}/stg_products")
    staged = spark.read.schema(good.schema).parquet(f"{root}/stg_products")
    return staged.groupBy(*staged.columns).agg(F.count(F.lit(1)).alias("copies"))


def _csv_lines(spark, sf_dir) -> DataFrame:
    """Customer lines with quoted commas, NULL tokens, a line that is too long and values of the wrong type."""
    c = B.table(spark, sf_dir, "customer")
    balance = F.when(F.col("c_nationkey") == 1, F.lit("n/a")).when(F.col("c_nationkey") == 2, F.lit("NULL")).otherwise(F.col("c_acctbal").cast("string"))
    segment = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("null")).when(F.col("c_mktsegment") == "MACHINERY", F.lit("")).otherwise(F.col("c_mktsegment"))
    tail = F.when(F.col("c_nationkey") == 3, F.lit(",extra,fields")).otherwise(F.lit(""))
    name = F.concat(F.lit('"'), F.col("c_name"), F.lit(', ""Ltd"""'))
    return c.select(F.concat(F.concat_ws(",", F.col("c_custkey").cast("string"), name, balance, segment), tail).alias("value"))


def _write_csv_text(spark, sf_dir, header: str) -> str:
    root = scratch_path(spark, "dialect")
    lines = _csv_lines(spark, sf_dir).repartition(3, "value").sortWithinPartitions("value")
    # the first line of every partition brings the header of its file
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    texts = F.when(first, F.array(F.lit(header), F.col("value"))).otherwise(F.array("value"))
    lines.withColumn("t", texts).select(F.explode("t").alias("value")).write.text(f"{root}/raw_customers")
    return f"{root}/raw_customers"


@query("csv_dialect_load", """
SELECT 'good' AS kind, c_custkey AS id, c_name || ', "Ltd"' AS name, CASE WHEN c_nationkey <> 2 THEN c_acctbal END AS balance,
  CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS segment, CAST(NULL AS VARCHAR) AS error FROM customer WHERE c_nationkey NOT IN (1, 3)
UNION ALL SELECT 'bad', NULL, NULL, NULL, NULL, CASE WHEN c_nationkey = 1 THEN 'bad balance' ELSE 'wrong number of fields' END FROM customer WHERE c_nationkey IN (1, 3)""")
def csv_dialect_load(spark, sf_dir) -> DataFrame:
    """Quotes, NULL tokens and bad lines: the load keeps going and returns the bad lines."""
    path = _write_csv_text(spark, sf_dir, "id,name,balance,segment")
    good, bad = read_csv(spark, path, "id bigint, name string, balance double, segment string", "*.txt")
    return good.withColumns({"kind": F.lit("good"), "error": F.lit(None).cast("string")}).unionByName(
        bad.select(F.lit("bad").alias("kind"), "error"), allowMissingColumns=True
    )


@query("external_csv", """
SELECT c_custkey AS id, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS segment, CAST(NULL AS VARCHAR) AS region FROM customer""")
def external_csv(spark, sf_dir) -> DataFrame:
    """Known columns by header name; the file's other columns are ignored, missing ones are NULL."""
    path = _write_csv_text(spark, sf_dir, "id,name,balance,segment")
    return read_external_csv(spark, path, "id bigint, segment string, region string", "*.txt")


@query("json_daily_bars", S.with_(S.RAW_STOCKS, select=f"""
SELECT ticker, {S.day('trade_date')} AS trade_date, open_price, CAST(0 AS DOUBLE) AS high_price, low_price, close_price, volume FROM raw_stocks"""))
def json_daily_bars(spark, sf_dir) -> DataFrame:
    """Daily series payload per ticker and month -> bars; the absent high becomes 0."""
    bars = B.raw_stocks(spark, sf_dir).filter(eligible_bars())
    day = F.struct(
        F.date_format("trade_date", "yyyy-MM-dd").alias("day"),
        F.create_map(
            F.lit("1. open"), F.col("open_price").cast("string"), F.lit("3. low"), F.col("low_price").cast("string"),
            F.lit("4. close"), F.col("close_price").cast("string"), F.lit("5. volume"), F.col("volume").cast("string"),
        ).alias("bar"),
    )
    # a payload holds at most the days of one month
    pages = bars.groupBy("ticker", F.date_format("trade_date", "yyyyMM").alias("m")).agg(F.map_from_entries(F.collect_list(day)).alias("series"))
    payload = pages.select(F.lower("ticker").alias("ticker"), F.to_json(F.struct(F.col("series").alias(payloads.BAR_SERIES))).alias("payload"))
    return payloads.daily_bars(payload)


@query("json_observations", f"""
SELECT event_id, 'u' || CAST(user_id AS VARCHAR) AS city, 'XX' AS country_code, {S.instant("date_trunc('second', ts)")} AS observation_dt, value AS temp_celsius,
  CAST(0 AS DOUBLE) AS temp_min_c, event_type AS weather_main, '' AS weather_desc, CASE WHEN event_type = 'error' THEN value ELSE 0.0 END AS snow_1h_mm, CAST(0 AS BIGINT) AS wind_deg
FROM events WHERE event_type <> 'signup'""")
def json_observations(spark, sf_dir) -> DataFrame:
    """Nested observation payload -> flat record; failed responses are dropped, missing numbers are 0."""
    e = B.table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    payload = F.to_json(
        F.struct(
            F.when(F.col("event_type") == "signup", 404).otherwise(200).alias("cod"), F.unix_timestamp(ts).alias("dt"),
            F.struct(F.lit("XX").alias("country")).alias("sys"),
            F.struct(F.col("value").alias("temp"), F.col("value").alias("feels_like")).alias("main"),
            F.when(F.col("event_type") == "error", F.struct(F.col("value").alias("1h"))).alias("snow"),
            F.array(F.struct(F.col("event_type").alias("main"))).alias("weather"),
            F.struct(F.col("event_id").cast("double").alias("lat")).alias("coord"),
        )
    )
    flat = payloads.observations(e.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("city"), payload.alias("payload")))
    return flat.select(
        F.col("latitude").cast("bigint").alias("event_id"), "city", "country_code", "observation_dt", "temp_celsius", "temp_min_c",
        "weather_main", "weather_desc", "snow_1h_mm", "wind_deg",
    )


@query("json_articles", """
SELECT CAST(doc_id AS VARCHAR) AS url, lang AS topic, split_part(text, chr(10), 1) AS title, source AS source_name, substring(text, 1, 500) AS content
FROM documents WHERE source <> 'src1'""")
def json_articles(spark, sf_dir) -> DataFrame:
    """Pages of articles -> one row each, without removed ones; stored content is cut to 500 characters."""
    d = B.table(spark, sf_dir, "documents")
    title = F.when(F.col("source") == "src1", F.lit(payloads.REMOVED_TITLE)).otherwise(F.substring_index("text", "\n", 1))
    article = F.struct(
        F.struct(F.lit("").alias("id"), F.col("source").alias("name")).alias("source"), title.alias("title"),
        F.col("doc_id").cast("string").alias("url"), F.lit("2024-01-02T03:04:05Z").alias("publishedAt"), F.col("text").alias("content"),
    )
    # a page holds at most 20 consecutive documents
    pages = d.groupBy("lang", F.floor(F.col("doc_id") / 20).alias("page")).agg(F.collect_list(article).alias("articles"))
    payload = pages.select(F.col("lang").alias("topic"), F.to_json(F.struct(F.lit("ok").alias("status"), "articles")).alias("payload"))
    return payloads.articles(payload).select("url", "topic", "title", "source_name", "content")


@query("union_extracts", """
SELECT event_type, COUNT(*) AS n, COUNT(*) FILTER (WHERE event_type = 'error') AS with_value FROM events GROUP BY 1""")
def union_extracts(spark, sf_dir) -> DataFrame:
    """Per-key extracts with different columns as one batch."""
    e = B.table(spark, sf_dir, "events")
    error = F.coalesce(F.col("event_type") == "error", F.lit(False))
    extracts = [e.filter(error).select("event_type", "value"), e.filter(~error).select("event_type")]
    return payloads.union_batches(extracts).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("with_value"))


@query("partitioned_write", S.with_(*S.SALES, select=f"""
SELECT {S.big('floor((order_date_key - 19950101) / 100)')} AS date_bucket, COUNT(*) AS n, {S.total('net_amount')} AS net_amount
FROM fact_sales WHERE order_date_key >= 19990101 GROUP BY 1"""))
def partitioned_write(spark, sf_dir) -> DataFrame:
    """Fact partitioned by a range bucket of the date key and clustered; the read prunes partitions."""
    path = scratch_path(spark, "clustered")
    fact = sales(spark, sf_dir).fact_sales
    write_clustered(fact, path, base=19950101)
    back = spark.read.schema(fact.schema.add("date_bucket", "integer")).parquet(path)
    recent = back.filter("date_bucket >= 400")
    return recent.groupBy("date_bucket").agg(F.count(F.lit(1)).alias("n"), sum_money("net_amount").alias("net_amount"))


@query("partitioned_write_whole", S.with_(*S.SALES, select=f"""
SELECT {S.big('floor((order_date_key - 19950101) / 100)')} AS date_bucket, COUNT(*) AS n, {S.total('net_amount')} AS net_amount FROM fact_sales GROUP BY 1"""))
def partitioned_write_whole(spark, sf_dir) -> DataFrame:
    """Every bucket of the clustered fact, read back."""
    path = scratch_path(spark, "clustered")
    fact = sales(spark, sf_dir).fact_sales
    write_clustered(fact, path, base=19950101)
    back = spark.read.schema(fact.schema.add("date_bucket", "integer")).parquet(path)
    return back.groupBy("date_bucket").agg(F.count(F.lit(1)).alias("n"), sum_money("net_amount").alias("net_amount"))


def _store(spark, sf_dir) -> TableStore:
    store = TableStore(spark, scratch_path(spark, "store"))
    txn = store.begin()
    txn.replace("raw_stock_prices", B.raw_stocks(spark, sf_dir))
    txn.replace("raw_weather_observations", B.raw_weather(spark, sf_dir))
    txn.replace("raw_news_articles", B.raw_news(spark, sf_dir))
    txn.replace("stg_customers", B.stg_customers(spark, sf_dir))
    txn.append("stg_customers", B.stg_customers(spark, sf_dir, "1996-01-01 00:00:00"))
    txn.commit()
    return store


_STORED = """stored AS (
  SELECT 'raw_stock_prices' AS table_name, (SELECT COUNT(*) FROM raw_stocks) AS n UNION ALL SELECT 'raw_weather_observations', (SELECT COUNT(*) FROM events)
  UNION ALL SELECT 'raw_news_articles', (SELECT COUNT(*) FROM documents) UNION ALL SELECT 'stg_customers', (SELECT 2 * COUNT(*) FROM customer))"""


@query("replicate_tables", S.with_(S.RAW_STOCKS, _STORED, select="SELECT table_name, n AS source_rows, n AS target_rows FROM stored"))
def replicate_tables(spark, sf_dir) -> DataFrame:
    """Whole-table copies into another store, reconciled by count."""
    return replicate(_store(spark, sf_dir), TableStore(spark, scratch_path(spark, "replica")))


@query("replicate_dry_run", S.with_(S.RAW_STOCKS, _STORED, select="SELECT table_name, n AS source_rows, CAST(NULL AS BIGINT) AS target_rows FROM stored"))
def replicate_dry_run(spark, sf_dir) -> DataFrame:
    return replicate(_store(spark, sf_dir), None)


@query("purge_domain", S.with_(S.RAW_STOCKS, _STORED, select="""
SELECT table_name, n AS deleted_rows, CAST(0 AS BIGINT) AS rows_left FROM stored WHERE table_name IN ('raw_weather_observations')"""))
def purge_domain(spark, sf_dir) -> DataFrame:
    """Deleted row counts of one domain; other domains stay."""
    store = _store(spark, sf_dir)
    deleted = purge(store, "weather")
    left = store.read("raw_weather_observations").agg(F.count(F.lit(1)).alias("n")).scalar()
    return deleted.withColumn("rows_left", left)


@query("table_preview", f"""
SELECT city, {S.instant('observation_dt')} AS observation_dt FROM (
  SELECT 'city-' || CAST(user_id AS VARCHAR) AS city, ts AS observation_dt, event_id FROM events) AS w ORDER BY w.observation_dt, city LIMIT 500""")
def table_preview(spark, sf_dir) -> DataFrame:
    """An allow-listed table, capped at 500 rows whatever was asked for."""
    tables = {"raw_weather_observations": B.raw_weather(spark, sf_dir)}
    return preview(tables, "raw_weather_observations", 10000, PREVIEW_TABLES, ["observation_dt", "city"]).select("city", "observation_dt")


@query("layer_materialise", """
SELECT event_type, COUNT(*) AS n, COUNT(*) AS from_table FROM events GROUP BY 1""")
def layer_materialise(spark, sf_dir) -> DataFrame:
    """The same model published as a view and as a table."""
    store = TableStore(spark, scratch_path(spark, "layers"))
    model = B.table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    publish_layer(spark, {"stg_event_counts": model}, "view")
    table = publish_layer(spark, {"core_event_counts": model}, "table", store)["core_event_counts"]
    return spark.table("stg_event_counts").join(table.withColumnRenamed("n", "from_table"), "event_type")
