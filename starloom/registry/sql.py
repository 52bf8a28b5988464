"""SQL fragments shared by the comparison queries."""

from __future__ import annotations


def rounded(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,6)), {digits}) AS DOUBLE)"


def money(expr: str) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,6)), 2) AS DECIMAL(12,2))"


def percent(num: str, den: str, digits: int = 2) -> str:
    return rounded(f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100", digits)


def mean(expr: str, scale: int = 6, digits: int = 2) -> str:
    return rounded(f"CAST(SUM(CAST({expr} AS DECIMAL(28,{scale}))) AS DOUBLE) / COUNT({expr})", digits)


def total(expr: str) -> str:
    return f"CAST(SUM({expr}) AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def instant(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def calendar(start: str, end: str) -> str:
    return f"""dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, strftime(d, '%A') AS day_name,
    strftime(d, '%B') AS month_name, CAST(EXTRACT(MONTH FROM d) AS BIGINT) AS month, CAST(EXTRACT(YEAR FROM d) AS BIGINT) AS year,
    CAST(EXTRACT(QUARTER FROM d) AS BIGINT) AS quarter
  FROM generate_series(DATE '{start}', DATE '{end}', INTERVAL 1 DAY) AS s(d))"""


SALES_DATES = calendar("1995-01-01", "2001-12-31")
EVENT_DATES = calendar("2024-01-01", "2024-12-31")

STG_ORDERS = f"""stg_orders AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_line_number, CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(l_partkey AS VARCHAR) AS product_id, o_orderdate AS order_timestamp, CAST(l_quantity AS INTEGER) AS quantity,
    {money('l_extendedprice / l_quantity')} AS unit_price, {money('l_extendedprice * l_discount')} AS discount_amount,
    {money('l_extendedprice * (1 - l_discount) * l_tax')} AS tax_amount, l_shipdate, l_partkey, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

CLEAN_ORDERS = """clean_orders AS (
  SELECT order_id, order_line_number, customer_id, product_id, order_timestamp, quantity, unit_price, discount_amount, tax_amount
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, order_line_number
          ORDER BY order_timestamp DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
        FROM stg_orders WHERE quantity > 0) AS r
  WHERE rn = 1)"""

DIM_PRODUCT = f"""dim_product AS (
  SELECT ROW_NUMBER() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS product_key, CAST(p_partkey AS VARCHAR) AS product_id,
    p_name AS product_name, p_type AS category, p_brand AS subcategory, {money('p_retailprice')} AS unit_price,
    {money('p_retailprice * CAST(0.6 AS DOUBLE)')} AS cost_price, TRUE AS is_active, TIMESTAMP '1995-01-01' AS updated_at
  FROM part)"""


def customers(start: str = "1995-01-01") -> str:
    """Two versions for customers with a low balance, one for the others."""
    return f"""people AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'Customer' AS first_name, c_name AS last_name,
    lower(c_name || '@Example.com') AS email, c_mktsegment AS tier, n_name AS city, '' AS state, r_name AS country, c_acctbal
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
dim_customer AS (
  SELECT customer_id || '/1' AS customer_key, customer_id, first_name, last_name, email, tier AS customer_tier, city, state, country,
    TIMESTAMP '{start}' AS effective_start_date,
    CASE WHEN c_acctbal < 3000 THEN TIMESTAMP '1998-01-01' END AS effective_end_date, NOT (c_acctbal < 3000) AS is_current
  FROM people
  UNION ALL
  SELECT customer_id || '/2', customer_id, first_name, last_name, email, tier || ' BASIC', city, state, country,
    TIMESTAMP '1998-01-01', NULL, TRUE
  FROM people WHERE c_acctbal < 3000)"""


DIM_CUSTOMER = customers()


def measures(zero_net: str = "null") -> str:
    margin = percent("profit_amount", "net_amount")
    if zero_net == "zero":
        margin = f"CASE WHEN net_amount > 0 THEN {margin} ELSE 0.0 END"
    return f"""fact_sales AS (
  SELECT *, CAST(net_amount - cost_amount AS DECIMAL(12,2)) AS profit_amount_, {margin} AS profit_margin_pct
  FROM (SELECT *, CAST(net_amount - cost_amount AS DECIMAL(12,2)) AS profit_amount FROM (
    SELECT o.*, CAST(strftime(o.order_timestamp, '%Y%m%d') AS INTEGER) AS order_date_key,
      CAST(o.quantity * o.unit_price AS DECIMAL(12,2)) AS gross_amount,
      CAST(o.quantity * o.unit_price - o.discount_amount + o.tax_amount AS DECIMAL(12,2)) AS net_amount,
      CAST(o.quantity * p.cost_price AS DECIMAL(12,2)) AS cost_amount, p.product_name
    FROM versioned AS o JOIN dim_product AS p ON o.product_id = p.product_id) AS m) AS n)"""


VERSIONED = """versioned AS (
  SELECT o.*, c.customer_key, c.customer_tier, c.effective_start_date
  FROM clean_orders AS o JOIN dim_customer AS c ON o.customer_id = c.customer_id
   AND o.order_timestamp >= c.effective_start_date
   AND (c.effective_end_date IS NULL OR o.order_timestamp < c.effective_end_date))"""

FACT_SALES = measures()

SALES = (STG_ORDERS, CLEAN_ORDERS, DIM_PRODUCT, DIM_CUSTOMER, VERSIONED, FACT_SALES, SALES_DATES)

RAW_STOCKS = """raw_stocks AS (
  SELECT upper(event_type) AS ticker, CAST(ts AS DATE) AS trade_date,
    arg_min(value, (ts, event_id)) AS open_price, MAX(value) AS high_price, MIN(value) AS low_price,
    arg_max(value, (ts, event_id)) AS close_price, COUNT(*) AS volume
  FROM events GROUP BY 1, 2)"""

FACT_STOCKS = f"""fact_stocks AS (
  SELECT *, CAST(strftime(trade_date, '%Y%m%d') AS INTEGER) AS date_key,
    {rounded('(close_price - prev) / NULLIF(prev, 0) * 100', 4)} AS daily_return_pct,
    {rounded('high_price - low_price', 4)} AS daily_range,
    {rounded('(high_price - low_price) / NULLIF(low_price, 0) * 100', 4)} AS daily_range_pct,
    {rounded('(open_price + high_price + low_price + close_price) / 4', 4)} AS avg_price
  FROM (SELECT *, LAG(close_price) OVER (PARTITION BY ticker ORDER BY trade_date) AS prev FROM raw_stocks
        WHERE close_price > 0 AND volume >= 0) AS b)"""

RAW_WEATHER = """raw_weather AS (
  SELECT 'city-' || CAST(user_id AS VARCHAR) AS city, 'XX' AS country_code, ts AS observation_dt, value AS temp_celsius,
    value - 2.0 AS temp_min_c, value + 2.0 AS temp_max_c, 1013 AS pressure_hpa,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity_pct, CAST(5.0 AS DOUBLE) AS wind_speed_ms, event_type AS weather_main,
    CASE WHEN event_type = 'error' THEN value ELSE 0.0 END AS rain_1h_mm, event_id
  FROM events)"""


def readings(low: float = -90.0, high: float = 60.0) -> str:
    return f"""fact_weather AS (
  SELECT *, CAST(strftime(observation_dt, '%Y%m%d') AS INTEGER) AS date_key FROM (
    SELECT *, CAST(EXTRACT(HOUR FROM observation_dt) AS BIGINT) AS observation_hour,
      ROW_NUMBER() OVER (PARTITION BY city, country_code, CAST(observation_dt AS DATE), EXTRACT(HOUR FROM observation_dt)
        ORDER BY observation_dt DESC, temp_celsius DESC) AS rn
    FROM raw_weather WHERE temp_celsius BETWEEN {low} AND {high}) AS r WHERE rn = 1)"""


FACT_WEATHER = readings()

RAW_NEWS = """raw_news AS (
  SELECT 'Source ' || source AS source_name, split_part(text, chr(10), 1) AS title, 'doc://' || CAST(doc_id AS VARCHAR) AS url,
    n_chars > 1000 AS has_image, make_timestamp((1704067200 + doc_id * 3607 % 2592000) * 1000000) AS published_at, lang AS topic
  FROM documents)"""

FACT_NEWS = """fact_news AS (
  SELECT *, CAST(strftime(published_at, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(length(trim(title)) - length(replace(trim(title), ' ', '')) + 1 AS BIGINT) AS title_word_count,
    CAST(EXTRACT(HOUR FROM published_at) AS BIGINT) AS published_hour
  FROM raw_news WHERE title IS NOT NULL AND trim(title) <> '')"""
