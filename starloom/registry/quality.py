"""Assertions, logs and audit pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import clean_customers, order_reject_rules, split_rejects
from ..operators.quality import (
    failure_alerts, layer_checks, load_checks, model_checks, quality_log, reject_log, run_assertions, staging_checks, summarize,
)
from ..plans import audit, marts
from ..plans import bindings as B
from ..session import materialize
from . import sql as S
from .cleaning import dirty_orders
from .core import query
from .reports import sales

CLOCK = "2024-12-31 00:00:00"


def _raw(spark, sf_dir) -> dict[str, DataFrame]:
    """Raw tables with seeded faults: blank tickers, negative prices, blank titles."""
    stocks = B.raw_stocks(spark, sf_dir)
    return {
        "raw_stock_prices": stocks.withColumns(
            {
                "ticker": F.when(F.col("ticker") != "CLICK", F.col("ticker")),
                "open_price": F.when(F.col("volume") > 70, -F.col("open_price")).otherwise(F.col("open_price")),
            }
        ),
        "raw_weather_observations": B.raw_weather(spark, sf_dir),
        "raw_news_articles": B.raw_news(spark, sf_dir).withColumn("title", F.when(F.col("topic") == "en", F.lit("  ")).otherwise(F.col("title"))),
    }


_GATES = f"""gates AS (
  SELECT 'raw_stock_prices' AS table_name, 'null_ticker_check' AS check_name, 'null_check' AS check_type, 'warning' AS severity,
    (SELECT COUNT(*) FROM raw_stocks) AS records_checked, (SELECT COUNT(*) FROM raw_stocks WHERE ticker = 'CLICK') AS records_failed
  UNION ALL SELECT 'raw_stock_prices', 'negative_price_check', 'range_check', 'error', (SELECT COUNT(*) FROM raw_stocks), (SELECT COUNT(*) FROM raw_stocks WHERE volume > 70)
  UNION ALL SELECT 'raw_weather_observations', 'temperature_range_check', 'range_check', 'warning', (SELECT COUNT(*) FROM events), (SELECT COUNT(*) FROM events WHERE value > 60 OR value < -90)
  UNION ALL SELECT 'raw_news_articles', 'null_title_check', 'null_check', 'warning', (SELECT COUNT(*) FROM documents), (SELECT COUNT(*) FROM documents WHERE lang = 'en')
  UNION ALL SELECT 'raw_stock_prices', 'record_count', 'count', 'info', (SELECT COUNT(*) FROM raw_stocks), 0
  UNION ALL SELECT 'raw_weather_observations', 'record_count', 'count', 'info', (SELECT COUNT(*) FROM events), 0
  UNION ALL SELECT 'raw_news_articles', 'record_count', 'count', 'info', (SELECT COUNT(*) FROM documents), 0),
judged AS (SELECT *, CASE WHEN records_failed = 0 THEN 'pass' WHEN severity IN ('info', 'warning') THEN 'warn' ELSE 'fail' END AS status FROM gates)"""


@query("staging_gates", S.with_(S.RAW_STOCKS, _GATES, select="SELECT * FROM judged"))
def staging_gates(spark, sf_dir) -> DataFrame:
    return run_assertions(_raw(spark, sf_dir), staging_checks())


@query("gate_summary", S.with_(S.RAW_STOCKS, _GATES, select="""
SELECT COUNT(*) AS checks, COUNT(*) FILTER (WHERE status = 'pass') AS passed, COUNT(*) FILTER (WHERE status = 'warn') AS warnings,
  COUNT(*) FILTER (WHERE status = 'fail') AS failed FROM judged"""))
def gate_summary(spark, sf_dir) -> DataFrame:
    return summarize(run_assertions(_raw(spark, sf_dir), staging_checks()))


@query("quality_log", S.with_(S.RAW_STOCKS, _GATES, select="""
SELECT 'run-1' AS pipeline_run_id, table_name, check_name, check_type, records_checked, records_failed,
  CASE WHEN records_failed > 0 THEN severity ELSE 'info' END AS severity,
  CAST(records_failed AS VARCHAR) || ' of ' || CAST(records_checked AS VARCHAR) || ' rows failed' AS details, '2024-12-31 00:00:00' AS checked_at FROM judged"""))
def quality_log_query(spark, sf_dir) -> DataFrame:
    results = run_assertions(_raw(spark, sf_dir), staging_checks())
    return quality_log(results, "run-1", F.lit(CLOCK).cast("timestamp")).drop("id")


@query("failure_alerts", S.with_(S.RAW_STOCKS, _GATES, select="""
SELECT 'critical' AS alert_type, 'Data Quality Check Failed on ''' || table_name || '''' AS title,
  'Check ''' || check_name || ''' failed for ' || CAST(records_failed AS VARCHAR) || ' record(s).' AS message, table_name, check_name, records_failed,
  'run-1' AS pipeline_run_id FROM judged WHERE status = 'fail'"""))
def failure_alerts_query(spark, sf_dir) -> DataFrame:
    return failure_alerts(run_assertions(_raw(spark, sf_dir), staging_checks()), "run-1")


def _broken_warehouse(spark, sf_dir) -> dict[str, DataFrame]:
    """A loaded warehouse in which PROMO products and high-value keys were damaged afterwards."""
    w = sales(spark, sf_dir)
    fact = materialize(w.fact_sales, "fact_sales")
    products = w.dim_product.filter("category <> 'PROMO'")
    damaged = fact.withColumn("sales_fact_key", F.when(F.col("net_amount") > 80000, F.lit(-1)).otherwise(F.col("sales_fact_key")))
    return {**w.tables(), "fact_sales": damaged, "dim_product": products}


_MODEL = f"""lost AS (SELECT COUNT(*) AS n FROM fact_sales AS f JOIN part AS p ON f.product_id = CAST(p.p_partkey AS VARCHAR) WHERE p.p_type = 'PROMO'),
facts AS (SELECT COUNT(*) AS n FROM fact_sales),
customers AS (SELECT COUNT(*) AS n FROM dim_customer),
products AS (SELECT COUNT(*) AS n FROM part WHERE p_type <> 'PROMO'),
high AS (SELECT COUNT(*) AS n FROM fact_sales WHERE net_amount > 80000)"""


@query("model_assertions", S.with_(*S.SALES, _MODEL, select="""
SELECT *, CASE WHEN records_failed = 0 THEN 'pass' WHEN severity = 'warning' THEN 'warn' ELSE 'fail' END AS status FROM (
  SELECT 'dim_customer' AS table_name, 'unique_customer_key' AS check_name, 'unique' AS check_type, 'critical' AS severity, (SELECT n FROM customers) AS records_checked, CAST(0 AS BIGINT) AS records_failed
  UNION ALL SELECT 'dim_customer', 'not_null_customer_id', 'null_check', 'critical', (SELECT n FROM customers), 0
  UNION ALL SELECT 'dim_product', 'unique_product_key', 'unique', 'critical', (SELECT n FROM products), 0
  UNION ALL SELECT 'dim_product', 'not_null_product_id', 'null_check', 'critical', (SELECT n FROM products), 0
  UNION ALL SELECT 'fact_sales', 'unique_sales_fact_key', 'unique', 'critical', (SELECT n FROM facts), (SELECT CASE WHEN n > 1 THEN 1 ELSE 0 END FROM high)
  UNION ALL SELECT 'fact_sales', 'foreign_key_customer_exists', 'relationships', 'critical', (SELECT n FROM facts), 0
  UNION ALL SELECT 'fact_sales', 'foreign_key_product_exists', 'relationships', 'critical', (SELECT n FROM facts), (SELECT n FROM lost)
  UNION ALL SELECT 'fact_sales', 'foreign_key_date_exists', 'relationships', 'critical', (SELECT n FROM facts), 0
  UNION ALL SELECT 'fact_sales', 'positive_net_amount_constraint', 'range_check', 'warning', (SELECT n FROM facts), (SELECT COUNT(*) FROM fact_sales WHERE net_amount < 0)) AS c"""))
def model_assertions(spark, sf_dir) -> DataFrame:
    return run_assertions(_broken_warehouse(spark, sf_dir), model_checks())


@query("load_gates", S.with_(*S.SALES, _MODEL, select="""
SELECT 'dim_customer' AS table_name, 'not_null_customer_key' AS check_name, (SELECT n FROM customers) AS records_checked, CAST(0 AS BIGINT) AS records_failed
UNION ALL SELECT 'dim_product', 'not_null_product_key', (SELECT n FROM products), 0
UNION ALL SELECT 'fact_sales', 'orphan_customer', (SELECT n FROM facts), 0
UNION ALL SELECT 'fact_sales', 'invalid_quantity', (SELECT n FROM facts), 0"""))
def load_gates(spark, sf_dir) -> DataFrame:
    return run_assertions(_broken_warehouse(spark, sf_dir), load_checks()).select("table_name", "check_name", "records_checked", "records_failed")


@query("layer_tests", S.with_(*S.SALES, select="""
SELECT CAST(28 AS BIGINT) AS checks, CAST(27 AS BIGINT) AS passed, CAST(0 AS BIGINT) AS warnings, CAST(1 AS BIGINT) AS failed,
  (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM customer) * 2 AS customer_rows_checked,
  (SELECT COUNT(*) FROM customer) AS unknown_tiers"""))
def layer_tests(spark, sf_dir) -> DataFrame:
    """All declared column tests; the test data's tiers are none of the accepted ones."""
    w = sales(spark, sf_dir, write_staging=True)
    fact = materialize(w.fact_sales, "fact_sales")
    customers = materialize(clean_customers(B.customer_batches(spark, sf_dir)[0]), "stg_customers")
    tables = {
        **w.tables(), "fact_sales": fact, "stg_customers": customers, "stg_products": w.stg_products, "stg_orders": w.stg_orders,
        "fct_mom_revenue": marts.mom_revenue(fact, w.dim_date),
        "fct_cohort_retention": marts.cohort_retention(fact, w.dim_customer, w.dim_date),
        "fct_rfm_segmentation": marts.rfm_scores(marts.rfm_metrics(fact, w.dim_customer, w.dim_date)),
    }
    results = materialize(run_assertions(tables, layer_checks()), "results")
    of_customers = results.filter("table_name = 'stg_customers'").agg(F.sum("records_checked").alias("n")).scalar()
    unknown = results.filter("check_name = 'accepted_values_customer_tier'").agg(F.sum("records_failed").alias("n")).scalar()
    return summarize(results).withColumns({"customer_rows_checked": of_customers, "unknown_tiers": unknown})


@query("reject_log_rows", S.with_(S.STG_ORDERS, select="""
SELECT 'stg_orders' AS table_name, 'Corrupt Value Filter Gate' AS check_name, 'critical' AS severity, COUNT(*) AS log_rows
FROM stg_orders WHERE quantity IN (1, 2, 13, 14, 15)"""))
def reject_log_rows(spark, sf_dir) -> DataFrame:
    _, rejects = split_rejects(dirty_orders(spark, sf_dir), order_reject_rules())
    log = reject_log(rejects, "stg_orders", "run-1", ["order_id", "quantity"])
    return log.groupBy("table_name", "check_name", "severity").agg(F.count(F.lit(1)).alias("log_rows"))


def pipeline_runs(spark, sf_dir) -> DataFrame:
    """One run per event type and hour; runs of errors failed."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    e = B.table(spark, sf_dir, "events")
    return e.groupBy(hour.alias("h"), "event_type").agg(
        F.min(F.col("ts").cast("timestamp")).alias("started_at"), F.max(F.col("ts").cast("timestamp")).alias("completed_at"), F.count(F.lit(1)).alias("n")
    ).select(
        F.concat("event_type", F.lit("-"), F.date_format("h", "yyyyMMddHH")).alias("id"), F.concat(F.lit("realtime_"), "event_type").alias("run_type"),
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"), "started_at", "completed_at",
        F.col("n").alias("records_extracted"), F.col("n").alias("records_loaded"), F.col("n").alias("records_transformed"),
        F.lit(0).cast("bigint").alias("records_rejected"), F.when(F.col("event_type") == "error", F.lit("boom")).alias("error_message"), F.lit("{}").alias("metadata"),
    )


def event_log(spark, sf_dir) -> DataFrame:
    """One quality-log row per event."""
    e = B.table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id").cast("string").alias("id"), F.concat("event_type", F.lit("-"), F.date_format(ts, "yyyyMMddHH")).alias("pipeline_run_id"),
        F.lit("stg_orders").alias("table_name"), F.col("event_type").alias("check_name"), F.lit("range_check").alias("check_type"),
        F.lit(1).cast("bigint").alias("records_checked"), F.floor("value").alias("records_failed"), F.lit("info").alias("severity"), F.lit("").alias("details"), ts.alias("checked_at"),
    )


_RUNS = """runs AS (
  SELECT event_type || '-' || strftime(ts, '%Y%m%d%H') AS id, 'realtime_' || event_type AS run_type,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status, MIN(ts) AS started_at, MAX(ts) AS completed_at, COUNT(*) AS n
  FROM events GROUP BY strftime(ts, '%Y%m%d%H'), event_type)"""


@query("run_history", S.with_(_RUNS, select=f"""
SELECT id, run_type, status, {S.instant('started_at')} AS started_at, n AS records_loaded FROM runs ORDER BY runs.started_at DESC, id LIMIT 20"""))
def run_history(spark, sf_dir) -> DataFrame:
    return audit.run_history(pipeline_runs(spark, sf_dir)).select("id", "run_type", "status", "started_at", "records_loaded")


@query("quality_history", f"""
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS check_name, {S.instant('ts')} AS checked_at, 'realtime_' || event_type AS pipeline_run_type
FROM events ORDER BY ts DESC, CAST(event_id AS VARCHAR) LIMIT 50""")
def quality_history(spark, sf_dir) -> DataFrame:
    """Newest quality-log rows with the type of their run."""
    return audit.quality_history(event_log(spark, sf_dir), pipeline_runs(spark, sf_dir)).select("id", "check_name", "checked_at", "pipeline_run_type")


@query("run_status_counts", S.with_(_RUNS, select="SELECT status, COUNT(*) AS n FROM runs GROUP BY 1"))
def run_status_counts(spark, sf_dir) -> DataFrame:
    return audit.status_counts(pipeline_runs(spark, sf_dir))


@query("latest_run", S.with_(_RUNS, select="SELECT id, run_type, status, n AS records_loaded FROM runs ORDER BY started_at DESC, id DESC LIMIT 1"))
def latest_run(spark, sf_dir) -> DataFrame:
    return audit.latest_run(pipeline_runs(spark, sf_dir)).select("id", "run_type", "status", "records_loaded")


@query("current_runs", S.with_(_RUNS, select=f"""
SELECT id, status, {S.instant('started_at')} AS started_at FROM runs"""))
def current_runs(spark, sf_dir) -> DataFrame:
    """Each run is logged when it starts and when it ends; the latest state counts."""
    done = pipeline_runs(spark, sf_dir)
    begun = done.withColumns({"status": F.lit("running"), "completed_at": F.lit(None).cast("timestamp")})
    return audit.current_runs(begun.unionByName(done)).select("id", "status", "started_at")


@query("stream_status", S.with_(_RUNS, select="""
SELECT (SELECT COUNT(*) FROM customer) AS dim_customer_rows, (SELECT COUNT(*) FROM part) AS dim_product_rows, (SELECT COUNT(*) FROM lineitem) AS fact_sales_rows,
  (SELECT COUNT(*) FROM events) AS total_quality_check_issues, id AS latest_run_id, run_type AS latest_run_type, status AS latest_run_status
FROM runs ORDER BY started_at DESC, id DESC LIMIT 1"""))
def stream_status(spark, sf_dir) -> DataFrame:
    tables = {n: B.table(spark, sf_dir, t) for n, t in {"dim_customer": "customer", "dim_product": "part", "fact_sales": "lineitem"}.items()}
    return audit.stream_status(tables, event_log(spark, sf_dir), pipeline_runs(spark, sf_dir))
