"""Stocks, weather, news and the cross-domain day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import month_label
from ..operators.measures import article_measures, bar_measures, eligible_articles, eligible_bars, eligible_observations
from ..operators.ranking import most_frequent, top
from ..operators.stats import price_forecast, scale_to_100, sentiment
from ..plans import bindings as B
from ..plans import domains, marts
from ..plans.calendar import date_dim
from ..session import materialize
from . import sql as S
from .core import query
from .reports import holt_sql, recursive


def calendar(spark) -> DataFrame:
    return date_dim(spark, *B.EVENT_CALENDAR)


def stocks(spark, sf_dir):
    raw = B.raw_stocks(spark, sf_dir)
    dim = materialize(domains.load_companies(schemas.empty(spark, schemas.DIM_COMPANY), raw), "dim_company")
    return dim, domains.stock_facts(raw, dim)


def weather(spark, sf_dir, temp_range=(-90.0, 60.0)):
    raw = B.raw_weather(spark, sf_dir)
    dim = materialize(domains.load_locations(schemas.empty(spark, schemas.DIM_LOCATION), raw), "dim_location")
    return dim, domains.reading_facts(raw, dim, temp_range=temp_range)


def news(spark, sf_dir):
    raw = B.raw_news(spark, sf_dir)
    dim = materialize(domains.load_sources(schemas.empty(spark, schemas.DIM_NEWS_SOURCE), raw), "dim_news_source")
    return dim, domains.article_facts(raw, dim)


STOCKS = (S.RAW_STOCKS, S.FACT_STOCKS)
WEATHER = (S.RAW_WEATHER, S.FACT_WEATHER)
NEWS = (S.RAW_NEWS, S.FACT_NEWS)


@query("daily_bars", S.with_(*STOCKS, select=f"""
SELECT ticker, {S.day('trade_date')} AS trade_date, open_price, high_price, low_price, close_price, volume,
  daily_return_pct, daily_range, daily_range_pct, avg_price FROM fact_stocks"""))
def daily_bars(spark, sf_dir) -> DataFrame:
    raw = B.raw_stocks(spark, sf_dir).filter(eligible_bars())
    return bar_measures(raw).drop("ingested_at", "source", "pipeline_run_id")


@query("stock_facts", S.with_(*STOCKS, select=f"""
SELECT ticker, {S.big('date_key')} AS date_key, close_price, volume, daily_return_pct, avg_price FROM fact_stocks"""))
def stock_facts(spark, sf_dir) -> DataFrame:
    dim, fact = stocks(spark, sf_dir)
    return fact.join(dim.select("company_key", "ticker"), "company_key").select("ticker", "date_key", "close_price", "volume", "daily_return_pct", "avg_price")


@query("stock_facts_incremental", S.with_(*STOCKS, select=f"""
SELECT ticker, {S.big('date_key')} AS date_key, daily_return_pct FROM fact_stocks WHERE date_key >= 20240116"""))
def stock_facts_incremental(spark, sf_dir) -> DataFrame:
    """The first bar of an increment still has a return: the lag looks at the loaded history."""
    dim, fact = stocks(spark, sf_dir)
    loaded = materialize(fact.filter("date_key < 20240116"), "fact_stock_prices")
    fresh = domains.stock_facts(B.raw_stocks(spark, sf_dir), dim, loaded)
    return fresh.join(dim.select("company_key", "ticker"), "company_key").select("ticker", "date_key", "daily_return_pct")


@query("stock_facts_upsert", S.with_(*STOCKS, select=f"""
SELECT ticker, {S.big('date_key')} AS date_key, CASE WHEN date_key < 20240116 THEN close_price + 1 ELSE close_price END AS close_price, open_price FROM fact_stocks"""))
def stock_facts_upsert(spark, sf_dir) -> DataFrame:
    """A corrected half month refreshes close and volume and leaves the open price."""
    dim, fact = stocks(spark, sf_dir)
    fact = materialize(fact, "fact_stock_prices")
    corrected = fact.filter("date_key < 20240116").withColumns({"close_price": F.col("close_price") + 1, "open_price": F.lit(0.0)})
    merged = domains.upsert_stock_facts(fact, corrected)
    return merged.join(dim.select("company_key", "ticker"), "company_key").select("ticker", "date_key", "close_price", "open_price")


@query("stock_monthly", S.with_(*STOCKS, S.EVENT_DATES, select=f"""
SELECT d.year, d.month, d.month_name, f.ticker, f.ticker AS company_name, COUNT(*) AS trading_days, {S.mean('f.close_price', 6, 4)} AS avg_close_price,
  {S.rounded('MIN(f.low_price)', 4)} AS monthly_low, {S.rounded('MAX(f.high_price)', 4)} AS monthly_high, CAST(SUM(f.volume) AS DOUBLE) AS total_volume,
  {S.mean('f.daily_return_pct', 6, 4)} AS avg_daily_return_pct, {S.mean('f.daily_range_pct', 6, 4)} AS avg_volatility_pct,
  {S.rounded('(MAX(f.close_price) - MIN(f.open_price)) / NULLIF(MIN(f.open_price), 0) * 100', 4)} AS monthly_return_pct
FROM fact_stocks AS f JOIN dim_date AS d ON f.date_key = d.date_key GROUP BY d.year, d.month, d.month_name, f.ticker"""))
def stock_monthly(spark, sf_dir) -> DataFrame:
    dim, fact = stocks(spark, sf_dir)
    return marts.stock_monthly(fact, dim, calendar(spark))


@query("stock_kpis", S.with_(*STOCKS, select=f"""
SELECT COUNT(DISTINCT ticker) AS total_companies, COUNT(*) AS total_trading_records, {S.day('MIN(trade_date)')} AS data_from, {S.day('MAX(trade_date)')} AS data_to,
  {S.mean('close_price')} AS avg_close_price, {S.mean('daily_return_pct', 6, 4)} AS avg_daily_return_pct, {S.mean('daily_range_pct', 6, 4)} AS avg_volatility_pct
FROM fact_stocks"""))
def stock_kpis(spark, sf_dir) -> DataFrame:
    _, fact = stocks(spark, sf_dir)
    return marts.stock_kpis(fact, calendar(spark))


_REG = """reg AS (
  SELECT ticker, COUNT(*) AS n, regr_slope(close_price, i - 1) AS slope, regr_intercept(close_price, i - 1) AS intercept,
    stddev_pop(daily_return_pct) AS vol, MAX(trade_date) AS last_day
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY trade_date) AS i FROM fact_stocks) AS p GROUP BY ticker)"""


@query("price_forecast", recursive(*STOCKS, holt_sql("holt", "fact_stocks", "ticker", "trade_date", "close_price", 0.4, 0.2, "x2 - x1"), _REG,
    """days AS (
  SELECT ticker, CAST(d AS DATE) AS forecast_date, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY d) AS horizon_day
  FROM reg, generate_series(last_day + INTERVAL 1 DAY, last_day + INTERVAL 30 DAY, INTERVAL 1 DAY) AS s(d) WHERE EXTRACT(ISODOW FROM d) < 6)""",
    f"""pred AS (
  SELECT r.ticker, d.forecast_date, d.horizon_day, r.slope, r.vol, h.xn AS last_close, {S.rounded(
      "0.6::DOUBLE * (h.level + d.horizon_day * h.trend) + 0.4::DOUBLE * (r.intercept + (r.n + d.horizon_day - 1) * r.slope)", 2)} AS p
  FROM reg AS r JOIN holt AS h ON h.k = r.ticker JOIN days AS d ON d.ticker = r.ticker WHERE r.n >= 5 AND d.horizon_day <= 14)""",
    f"""banded AS (SELECT *, {S.rounded('p * (vol / 100) * sqrt(horizon_day) * 1.96::DOUBLE', 2)} AS margin FROM pred)""", select=f"""
SELECT ticker, {S.day('forecast_date')} AS forecast_date, horizon_day, p AS predicted_close, {S.rounded('p + margin', 2)} AS upper_bound_95,
  {S.rounded('GREATEST(1.0::DOUBLE, p - margin)', 2)} AS lower_bound_95, {S.rounded('(p - last_close) / last_close * 100', 2)} AS predicted_change_pct,
  {S.rounded('vol', 2)} AS expected_volatility_pct, CASE WHEN slope > 0 THEN 'Bullish' ELSE 'Bearish' END AS trend_direction FROM banded"""))
def price_forecast_query(spark, sf_dir) -> DataFrame:
    bars = bar_measures(B.raw_stocks(spark, sf_dir).filter(eligible_bars()))
    return price_forecast(bars)


@query("observation_facts", S.with_(*WEATHER, select=f"""
SELECT city, {S.big('date_key')} AS date_key, observation_hour, temp_celsius, humidity_pct::BIGINT AS humidity_pct, weather_main, rain_1h_mm FROM fact_weather"""))
def observation_facts(spark, sf_dir) -> DataFrame:
    """Readings in the plausible range, newest per place and hour, missing rain as 0."""
    dim, fact = weather(spark, sf_dir)
    return fact.join(dim.select("location_key", "city"), "location_key").select(
        "city", "date_key", "observation_hour", "temp_celsius", "humidity_pct", "weather_main", "rain_1h_mm"
    )


@query("observation_incremental", S.with_(*WEATHER, select=f"""
SELECT city, {S.big('date_key')} AS date_key, observation_hour FROM fact_weather WHERE date_key >= 20240116"""))
def observation_incremental(spark, sf_dir) -> DataFrame:
    """Hours already loaded for a place are skipped."""
    dim, fact = weather(spark, sf_dir)
    loaded = materialize(fact.filter("date_key < 20240116"), "fact_weather_readings")
    fresh = domains.reading_facts(B.raw_weather(spark, sf_dir), dim, loaded)
    return fresh.join(dim.select("location_key", "city"), "location_key").select("city", "date_key", "observation_hour")


@query("locations", """
SELECT 'city-' || CAST(user_id AS VARCHAR) AS city, 'XX' AS country_code, CAST(user_id AS DOUBLE) AS latitude, CAST(-user_id AS DOUBLE) AS longitude
FROM events GROUP BY user_id""")
def locations(spark, sf_dir) -> DataFrame:
    """First coordinates per place; a second load of the same places only refreshes them."""
    raw = B.raw_weather(spark, sf_dir)
    dim = materialize(domains.load_locations(schemas.empty(spark, schemas.DIM_LOCATION), raw.withColumn("latitude", F.lit(0.0))), "dim_location")
    return domains.refresh_locations(dim, raw).drop("location_key")


@query("observation_daily", S.with_(*WEATHER, S.EVENT_DATES, """daily AS (
  SELECT f.*, d.full_date, d.day_name, d.month_name, d.year FROM fact_weather AS f JOIN dim_date AS d ON f.date_key = d.date_key)""",
  """modes AS (
  SELECT full_date, city, weather_main AS dominant_weather FROM (
    SELECT full_date, city, weather_main, ROW_NUMBER() OVER (PARTITION BY full_date, city ORDER BY COUNT(*) DESC, weather_main) AS rn
    FROM daily GROUP BY full_date, city, weather_main) AS m WHERE rn = 1)""", select=f"""
SELECT {S.day('d.full_date')} AS full_date, d.day_name, d.month_name, d.year, d.city, d.country_code, COUNT(*) AS observation_count,
  {S.mean('d.temp_celsius')} AS avg_temp_c, {S.rounded('MIN(d.temp_min_c)', 2)} AS daily_min_temp_c, {S.rounded('MAX(d.temp_max_c)', 2)} AS daily_max_temp_c,
  {S.mean('d.humidity_pct', 6, 1)} AS avg_humidity_pct, {S.mean('d.wind_speed_ms')} AS avg_wind_speed_ms, {S.mean('d.pressure_hpa', 6, 0)} AS avg_pressure_hpa,
  {S.rounded('SUM(CAST(d.rain_1h_mm AS DECIMAL(18,6)))', 2)} AS total_rain_mm, CAST(0 AS DOUBLE) AS total_snow_mm, MIN(m.dominant_weather) AS dominant_weather
FROM daily AS d JOIN modes AS m ON m.full_date = d.full_date AND m.city = d.city
GROUP BY d.full_date, d.day_name, d.month_name, d.year, d.city, d.country_code"""))
def observation_daily(spark, sf_dir) -> DataFrame:
    dim, fact = weather(spark, sf_dir)
    return marts.weather_daily(fact, dim, calendar(spark))


@query("weather_kpis", S.with_(*WEATHER, select=f"""
SELECT COUNT(DISTINCT city) AS total_cities, COUNT(*) AS total_observations, {S.mean('temp_celsius')} AS avg_global_temp_c,
  {S.rounded('MIN(temp_celsius)', 2)} AS min_recorded_temp_c, {S.rounded('MAX(temp_celsius)', 2)} AS max_recorded_temp_c,
  {S.mean('humidity_pct', 6, 1)} AS avg_humidity_pct, {S.mean('wind_speed_ms')} AS avg_wind_speed_ms FROM fact_weather"""))
def weather_kpis(spark, sf_dir) -> DataFrame:
    _, fact = weather(spark, sf_dir)
    return marts.weather_kpis(fact)


@query("dominant_value", """
SELECT user_id, event_type AS dominant FROM (
  SELECT user_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, event_type) AS rn FROM events GROUP BY 1, 2) AS m WHERE rn = 1""")
def dominant_value(spark, sf_dir) -> DataFrame:
    return most_frequent(B.table(spark, sf_dir, "events"), ["user_id"], "event_type", "dominant")


@query("group_outliers", S.with_(S.RAW_WEATHER, S.readings(-90.0, 1000.0), """stats AS (
  SELECT city, CAST(SUM(CAST(temp_celsius AS DECIMAL(28,6))) AS DOUBLE) / COUNT(*) AS mean,
    CASE WHEN COALESCE(stddev_pop(temp_celsius), 0) = 0 THEN 1.0::DOUBLE ELSE stddev_pop(temp_celsius) END AS std FROM fact_weather GROUP BY city)""",
  f"""z AS (SELECT f.*, s.mean, {S.rounded('(f.temp_celsius - s.mean) / s.std', 2)} AS z_score FROM fact_weather AS f JOIN stats AS s ON f.city = s.city)""",
  select=f"""
SELECT {S.day('observation_dt')} AS full_date, observation_hour, city, country_code AS country, temp_celsius, {S.rounded('mean', 1)} AS city_avg_temp, z_score,
  CASE WHEN z_score > 0 THEN 'Heatwave (High Temp)' ELSE 'Cold Snap (Low Temp)' END AS anomaly_type,
  CASE WHEN abs(z_score) >= 2 THEN 'High' ELSE 'Moderate' END AS severity, weather_main AS weather_condition FROM z WHERE abs(z_score) >= 1.5"""))
def group_outliers(spark, sf_dir) -> DataFrame:
    dim, fact = weather(spark, sf_dir, (-90.0, 1000.0))
    return marts.weather_outliers(fact, dim, calendar(spark))


@query("article_facts", S.with_(*NEWS, select=f"""
SELECT url, title, topic, {S.big('date_key')} AS date_key, title_word_count, has_image, published_hour, source_name FROM fact_news"""))
def article_facts(spark, sf_dir) -> DataFrame:
    dim, fact = news(spark, sf_dir)
    return fact.join(dim.select("source_key", "source_name"), "source_key").select(
        "url", "title", "topic", "date_key", "title_word_count", "has_image", "published_hour", "source_name"
    )


@query("article_measures", S.with_(*NEWS, select=f"""
SELECT url, {S.big('date_key')} AS date_key, title_word_count, has_image, published_hour, lower(replace(source_name, ' ', '-')) AS source_id FROM fact_news"""))
def article_measures_query(spark, sf_dir) -> DataFrame:
    from ..operators.measures import source_identifier

    measured = article_measures(B.raw_news(spark, sf_dir).filter(eligible_articles()))
    return measured.withColumn("source_id", source_identifier()).select("url", "date_key", "title_word_count", "has_image", "published_hour", "source_id")


@query("article_upsert", S.with_(*NEWS, select="""
SELECT url, CASE WHEN has_image THEN 'corrected' ELSE title END AS title, topic FROM fact_news"""))
def article_upsert(spark, sf_dir) -> DataFrame:
    """Corrected articles refresh title and description; the topic stays."""
    _, fact = news(spark, sf_dir)
    fact = materialize(fact, "fact_news_articles")
    corrected = fact.filter("has_image").withColumns({"title": F.lit("corrected"), "topic": F.lit("ignored")})
    return domains.upsert_article_facts(fact, corrected).select("url", "title", "topic")


@query("article_incremental_without_url", "SELECT COUNT(*) FILTER (WHERE lang <> 'en') AS new_rows FROM documents")
def article_incremental_without_url(spark, sf_dir) -> DataFrame:
    """Articles without a url are told apart by source, title and hour, so a rerun loads only the unseen ones."""
    raw = B.raw_news(spark, sf_dir).withColumns({"url": F.lit(None).cast("string"), "title": F.concat(F.col("url"), F.lit(" "), F.col("title"))})
    dim = materialize(domains.load_sources(schemas.empty(spark, schemas.DIM_NEWS_SOURCE), raw), "dim_news_source")
    loaded = materialize(domains.article_facts(raw.filter("topic = 'en'"), dim), "fact_news_articles")
    return domains.article_facts(raw, dim, loaded).agg(F.count(F.lit(1)).alias("new_rows"))


@query("article_daily", S.with_(*NEWS, S.EVENT_DATES, select=f"""
SELECT {S.day('d.full_date')} AS full_date, d.day_name, d.year, d.month, f.topic, f.source_name, COUNT(*) AS article_count,
  {S.mean('f.title_word_count', 0, 1)} AS avg_title_length, COUNT(*) FILTER (WHERE f.has_image) AS articles_with_images,
  {S.percent('COUNT(*) FILTER (WHERE f.has_image)', 'COUNT(*)', 1)} AS image_coverage_pct
FROM fact_news AS f JOIN dim_date AS d ON f.date_key = d.date_key GROUP BY d.full_date, d.day_name, d.year, d.month, f.topic, f.source_name"""))
def article_daily(spark, sf_dir) -> DataFrame:
    dim, fact = news(spark, sf_dir)
    return marts.news_daily(fact, dim, calendar(spark))


@query("news_kpis", S.with_(*NEWS, select=f"""
SELECT COUNT(*) AS total_articles, COUNT(DISTINCT source_name) AS total_sources, COUNT(DISTINCT topic) AS total_topics,
  {S.rounded('CAST(SUM(title_word_count) AS DOUBLE) / COUNT(*)', 1)} AS avg_title_length, COUNT(*) FILTER (WHERE has_image) AS articles_with_images FROM fact_news"""))
def news_kpis(spark, sf_dir) -> DataFrame:
    _, fact = news(spark, sf_dir)
    return marts.news_kpis(fact)


@query("top_sources", S.with_(*NEWS, select="""
SELECT source_name, COUNT(*) AS article_count FROM fact_news GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def top_sources(spark, sf_dir) -> DataFrame:
    dim, fact = news(spark, sf_dir)
    return marts.top_sources(fact, dim)


@query("newest_headlines", S.with_(*NEWS, select=f"""
SELECT url, topic, {S.big('date_key')} AS date_key FROM fact_news ORDER BY date_key DESC, published_hour DESC, url LIMIT 15"""))
def newest_headlines(spark, sf_dir) -> DataFrame:
    _, fact = news(spark, sf_dir)
    order = [F.col("date_key").desc(), F.col("published_hour").desc(), F.col("url").asc()]
    return top(fact, order, 15).select("url", "topic", "date_key")


POSITIVE, NEGATIVE = ["red", "ring", "steel", "new"], ["small", "old", "bolt", "gear"]


def _words(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_LABELLED = f"""scored AS (
  SELECT *, CASE WHEN up > down THEN 'Positive' WHEN down > up THEN 'Negative' ELSE 'Neutral' END AS label,
    CASE WHEN up > down THEN 0.65::DOUBLE WHEN down > up THEN -0.65::DOUBLE ELSE 0.0::DOUBLE END AS score FROM (
    SELECT *, len(list_intersect(tokens, {_words(POSITIVE)})) AS up, len(list_intersect(tokens, {_words(NEGATIVE)})) AS down FROM (
      SELECT *, list_distinct(regexp_split_to_array(lower(p_name), '\\s+')) AS tokens FROM part) AS t) AS c)"""


@query("lexicon_sentiment", f"""WITH {_LABELLED}, rolled AS (
SELECT p_type AS topic, COUNT(*) AS article_count, COUNT(*) FILTER (WHERE label = 'Positive') AS positive_count, COUNT(*) FILTER (WHERE label = 'Negative') AS negative_count,
  COUNT(*) FILTER (WHERE label = 'Neutral') AS neutral_count, {S.mean('score', 2)} AS avg_sentiment_score FROM scored GROUP BY 1)
SELECT *, CASE WHEN avg_sentiment_score > 0.1 THEN 'Bullish' WHEN avg_sentiment_score < -0.1 THEN 'Bearish' ELSE 'Neutral' END AS overall_sentiment FROM rolled""")
def lexicon_sentiment(spark, sf_dir) -> DataFrame:
    titles = B.table(spark, sf_dir, "part").select(F.col("p_name").alias("title"), F.col("p_type").alias("topic"))
    return marts.news_sentiment(titles, POSITIVE, NEGATIVE)


@query("classified_titles", f"WITH {_LABELLED} SELECT p_partkey, label AS sentiment_label, score AS sentiment_score FROM scored")
def classified_titles(spark, sf_dir) -> DataFrame:
    return sentiment(B.table(spark, sf_dir, "part"), "p_name", POSITIVE, NEGATIVE).select("p_partkey", "sentiment_label", "sentiment_score")


_CROSS = f"""cross_daily AS (
  SELECT d.full_date, d.day_name, d.month_name, d.year, d.quarter, COALESCE(s.a, 0) AS stocks_avg_close, COALESCE(s.v, 0) AS stocks_total_volume,
    COALESCE(s.r, 0) AS stocks_avg_return_pct, COALESCE(w.t, 0) AS weather_avg_temp_c, COALESCE(w.h, 0) AS weather_avg_humidity_pct, COALESCE(n.c, 0) AS news_article_count
  FROM dim_date AS d
  LEFT JOIN (SELECT date_key, {S.mean('close_price', 6, 4)} AS a, {S.big('SUM(volume)')} AS v, {S.mean('daily_return_pct', 6, 4)} AS r FROM fact_stocks GROUP BY 1) AS s ON s.date_key = d.date_key
  LEFT JOIN (SELECT date_key, {S.mean('temp_celsius')} AS t, {S.mean('humidity_pct', 6, 1)} AS h FROM fact_weather GROUP BY 1) AS w ON w.date_key = d.date_key
  LEFT JOIN (SELECT date_key, COUNT(*) AS c FROM fact_news GROUP BY 1) AS n ON n.date_key = d.date_key
  WHERE s.date_key IS NOT NULL OR w.date_key IS NOT NULL OR n.date_key IS NOT NULL)"""


def _cross(spark, sf_dir) -> DataFrame:
    return marts.cross_domain_daily(calendar(spark), stocks(spark, sf_dir)[1], weather(spark, sf_dir)[1], news(spark, sf_dir)[1])


@query("cross_domain_daily", S.with_(*STOCKS, *WEATHER, *NEWS, S.EVENT_DATES, _CROSS, select=f"""
SELECT {S.day('full_date')} AS full_date, day_name, month_name, year, quarter, stocks_avg_close, stocks_total_volume, stocks_avg_return_pct,
  weather_avg_temp_c, weather_avg_humidity_pct, news_article_count FROM cross_daily"""))
def cross_domain_daily(spark, sf_dir) -> DataFrame:
    return _cross(spark, sf_dir)


@query("normalised_series", S.with_(*STOCKS, *WEATHER, *NEWS, S.EVENT_DATES, _CROSS, select=f"""
SELECT {S.day('full_date')} AS full_date, {S.rounded('stocks_avg_close / (SELECT MAX(stocks_avg_close) FROM cross_daily) * 100', 4)} AS stocks_scaled,
  {S.rounded('''(weather_avg_temp_c - (SELECT MIN(weather_avg_temp_c) FROM cross_daily))
    / ((SELECT MAX(weather_avg_temp_c) FROM cross_daily) - (SELECT MIN(weather_avg_temp_c) FROM cross_daily)) * 100''', 4)} AS temperature_scaled,
  {S.rounded('CAST(news_article_count AS DOUBLE) / (SELECT MAX(news_article_count) FROM cross_daily) * 100', 4)} AS news_scaled FROM cross_daily"""))
def normalised_series(spark, sf_dir) -> DataFrame:
    specs = {
        "stocks_scaled": ("stocks_avg_close", "max"),
        "temperature_scaled": ("weather_avg_temp_c", "range"),
        "news_scaled": ("news_article_count", "max"),
    }
    daily = materialize(_cross(spark, sf_dir), "cross_daily")
    return scale_to_100(daily, specs).select("full_date", *specs)


@query("bars_upsert", f"""
SELECT upper(event_type) AS ticker, {S.day('CAST(ts AS DATE)')} AS trade_date, MAX(value) + CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-11' THEN 1 ELSE 0 END AS close_price,
  COUNT(*) AS volume, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-11' THEN 'load-2' ELSE 'load-1' END AS pipeline_run_id, 'events' AS source
FROM events GROUP BY ticker, CAST(ts AS DATE)""")
def bars_upsert(spark, sf_dir) -> DataFrame:
    """Two overlapping batches of raw bars; a bar sent twice in one batch counts once."""
    raw = B.raw_stocks(spark, sf_dir).withColumn("close_price", F.col("high_price"))
    first = raw.filter("trade_date < '2024-01-21'")
    second = raw.filter("trade_date >= '2024-01-11'").withColumns({"close_price": F.col("close_price") + 1, "pipeline_run_id": F.lit("load-2")})
    repeated = second.unionByName(second.withColumns({"ingested_at": F.lit("2000-01-01").cast("timestamp"), "close_price": F.lit(0.0)}))
    merged = domains.upsert_raw_stocks(first, repeated)
    return merged.select("ticker", "trade_date", "close_price", "volume", "pipeline_run_id", "source")


@query("observations_append", """
SELECT weather_main, COUNT(*) AS n, CAST(SUM(rain) AS DOUBLE) AS rain FROM (
  SELECT event_type AS weather_main, CAST(0 AS DECIMAL(18,2)) AS rain FROM events WHERE event_type <> 'error'
  UNION ALL SELECT event_type, CAST(value AS DECIMAL(18,2)) FROM events WHERE event_type = 'error'
  UNION ALL SELECT '', CAST(0 AS DECIMAL(18,2)) FROM events) AS u GROUP BY 1""")
def observations_append(spark, sf_dir) -> DataFrame:
    """Appended observations with missing fields defaulted."""
    raw = B.raw_weather(spark, sf_dir)
    bare = raw.withColumns({"weather_main": F.lit(None).cast("string"), "rain_1h_mm": F.lit(None).cast("double")})
    stored = domains.append_raw_weather(raw, bare)
    return stored.groupBy("weather_main").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("rain_1h_mm").cast("decimal(18,2)")).cast("double"), F.lit(0.0)).alias("rain")
    )


@query("articles_upsert", """
SELECT 'doc://' || CAST(doc_id AS VARCHAR) AS url, CASE WHEN lang = 'de' THEN 'new title' ELSE split_part(text, chr(10), 1) END AS title,
  'documents' AS source_api, CASE WHEN lang = 'de' THEN 'load-2' ELSE 'load-1' END AS pipeline_run_id FROM documents""")
def articles_upsert(spark, sf_dir) -> DataFrame:
    """Raw articles by url: mutable fields refreshed, the rest kept."""
    raw = B.raw_news(spark, sf_dir)
    again = raw.filter("topic = 'de'").withColumns(
        {"title": F.lit("new title"), "source_api": F.lit("ignored"), "pipeline_run_id": F.lit("load-2"), "ingested_at": F.lit("2024-06-01").cast("timestamp")}
    )
    return domains.upsert_raw_news(raw, again).select("url", "title", "source_api", "pipeline_run_id")


@query("eligibility", """
SELECT strftime(ts, '%Y-%m') AS month, COUNT(*) FILTER (WHERE value BETWEEN -90 AND 60) AS in_range, COUNT(*) FILTER (WHERE NOT value BETWEEN -90 AND 60) AS out_of_range
FROM events GROUP BY 1""")
def eligibility(spark, sf_dir) -> DataFrame:
    ok = eligible_observations()
    raw = B.raw_weather(spark, sf_dir)
    return raw.groupBy(month_label("observation_dt").alias("month")).agg(F.count_if(ok).alias("in_range"), F.count_if(~ok).alias("out_of_range"))
