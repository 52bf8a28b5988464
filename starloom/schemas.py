"""Column types of the staging, warehouse and audit tables, as DDL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STG_CUSTOMERS = (
    "raw_customer_id string, first_name string, last_name string, email string, customer_tier string, "
    "city string, state string, country string, updated_at timestamp"
)
STG_PRODUCTS = (
    "raw_product_id string, product_name string, category string, subcategory string, "
    "unit_price decimal(12,2), cost_price decimal(12,2), updated_at timestamp"
)
STG_ORDERS = (
    "order_id string, order_line_number int, customer_id string, product_id string, order_timestamp timestamp, "
    "quantity int, unit_price decimal(12,2), discount_amount decimal(12,2), tax_amount decimal(12,2)"
)
DIM_CUSTOMER = (
    "customer_key bigint, customer_id string, first_name string, last_name string, email string, customer_tier string, "
    "city string, state string, country string, effective_start_date timestamp, effective_end_date timestamp, is_current boolean"
)
DIM_PRODUCT = (
    "product_key bigint, product_id string, product_name string, category string, subcategory string, "
    "unit_price decimal(12,2), cost_price decimal(12,2), is_active boolean, updated_at timestamp"
)
FACT_SALES = (
    "sales_fact_key bigint, order_id string, order_line_number int, customer_key bigint, product_key bigint, "
    "order_date_key int, quantity int, unit_price decimal(12,2), gross_amount decimal(12,2), discount_amount decimal(12,2), "
    "tax_amount decimal(12,2), net_amount decimal(12,2), cost_amount decimal(12,2), profit_amount decimal(12,2), "
    "profit_margin_pct double, created_at timestamp"
)
RAW_STOCK_PRICES = (
    "ticker string, trade_date date, open_price double, high_price double, low_price double, close_price double, "
    "volume bigint, source string, ingested_at timestamp, pipeline_run_id string"
)
RAW_WEATHER = (
    "city string, country_code string, observation_dt timestamp, temp_celsius double, feels_like_c double, "
    "temp_min_c double, temp_max_c double, pressure_hpa int, humidity_pct int, wind_speed_ms double, wind_deg int, "
    "clouds_pct int, weather_main string, weather_desc string, visibility_m int, rain_1h_mm double, snow_1h_mm double, "
    "latitude double, longitude double, source string, ingested_at timestamp, pipeline_run_id string"
)
RAW_NEWS = (
    "source_id string, source_name string, author string, title string, description string, url string, "
    "url_to_image string, published_at timestamp, content string, topic string, source_api string, "
    "ingested_at timestamp, pipeline_run_id string"
)
DIM_COMPANY = "company_key bigint, ticker string, company_name string, effective_start_date timestamp, is_current boolean"
DIM_LOCATION = "location_key bigint, city string, country_code string, latitude double, longitude double"
DIM_NEWS_SOURCE = "source_key bigint, source_id string, source_name string"
STG_FINANCE = (
    "raw_id string, amount decimal(12,2), category_name string, category_type string, merchant string, "
    "transaction_date date, notes string, ingested_at timestamp"
)
STG_FITNESS = (
    "raw_id string, workout_name string, workout_category string, duration_minutes int, calories_burned int, "
    "workout_date date, intensity string, ingested_at timestamp"
)
STG_MEDIA = (
    "raw_id string, title string, media_type string, genre string, creator string, consumed_date date, "
    "rating double, notes string, ingested_at timestamp"
)
DIM_CATEGORY = "category_key bigint, category_name string, category_type string"
DIM_WORKOUT_TYPE = "workout_type_key bigint, workout_name string, workout_category string"
DIM_MEDIA_ITEM = "media_key bigint, title string, media_type string, genre string, creator string"
PIPELINE_RUNS = (
    "id string, run_type string, status string, started_at timestamp, completed_at timestamp, records_extracted bigint, "
    "records_loaded bigint, records_transformed bigint, records_rejected bigint, error_message string, metadata string"
)
DATA_QUALITY_LOG = (
    "id string, pipeline_run_id string, table_name string, check_name string, check_type string, records_checked bigint, "
    "records_failed bigint, severity string, details string, checked_at timestamp"
)


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    """A table of that shape without rows."""
    return spark.createDataFrame([], ddl)
