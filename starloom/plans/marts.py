"""Reporting marts over the star schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import month_label, period_label
from ..functions.numbers import avg_exact, percent, round_half_up, safe_ratio, sum_money
from ..functions.text import full_name
from ..operators.joins import current_only, spine_join
from ..operators.measures import high_value_orders
from ..operators.profile import sum_if
from ..operators.ranking import most_frequent, ntile_by_selection, top, top_groups
from ..operators.stats import churn_scores, sentiment, sentiment_by, zscore_outliers
from ..session import materialize

# Segment names of the recency / frequency / monetary grid.
SEGMENTS = ("Champions (VIP)", "Loyal Customers", "Recent New Customers", "At Risk Customers", "Hibernating / Lost")


def _dated(fact: DataFrame, dim_date: DataFrame, columns: Sequence[str], key: str = "order_date_key") -> DataFrame:
    calendar = dim_date.select(F.col("date_key").alias(key), *columns)
    return fact.join(calendar, key)


# --- sales ---------------------------------------------------------------------------------


def monthly_sales(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Sales totals per calendar month."""
    return (
        _dated(fact, dim_date, ["year", "month", "month_name"])
        .groupBy("year", "month", "month_name")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count(F.lit(1)).alias("total_order_items"),
            F.sum("quantity").alias("total_units_sold"),
            sum_money("gross_amount").alias("total_gross_revenue"),
            sum_money("discount_amount").alias("total_discounts"),
            sum_money("net_amount").alias("total_net_revenue"),
            sum_money("cost_amount").alias("total_cost"),
            sum_money("profit_amount").alias("total_profit"),
        )
    )


def mom_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Month-over-month revenue, discounts, margin and growth."""
    months = W.orderBy("year", "month")  # one row per month: bounded by the calendar
    prior = F.lag("total_net_revenue").over(months)
    return (
        monthly_sales(fact, dim_date)
        .withColumn("prior_month_net_revenue", prior)
        .select(
            "year", "month", "month_name", "total_orders", "total_units_sold", "total_gross_revenue", "total_discounts",
            "total_net_revenue", "prior_month_net_revenue",
            percent(F.col("total_net_revenue") - F.col("prior_month_net_revenue"), "prior_month_net_revenue").alias("mom_net_revenue_growth_pct"),
            "total_profit",
            percent("total_profit", "total_net_revenue").alias("overall_profit_margin_pct"),
        )
        .orderBy("year", "month")
    )


def cohort_retention(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, grain: str = "customer_key") -> DataFrame:
    """Retention and revenue per first-purchase month and activity month.

    Members are customer versions by default; ``grain="customer_id"`` follows the person. Facts are
    first reduced to one row per member and month; the first month is then a minimum over a
    member's few months, so the fact is read once and nothing is joined back to it.
    """
    names = ["customer_id"] if grain == "customer_id" else ["customer_key", "customer_id"]
    member = names[0]
    activity = (
        _dated(fact, dim_date, ["full_date"])
        .groupBy("customer_key", month_label("full_date").alias("activity_month"))
        .agg(F.sum("net_amount").alias("spend"))
        .join(dim_customer.select("customer_key", "customer_id"), "customer_key")
    )
    if grain == "customer_id":
        activity = activity.groupBy("customer_id", "activity_month").agg(F.sum("spend").alias("spend"))
    cohort = F.min("activity_month").over(W.partitionBy(member))
    tagged = activity.withColumn("cohort_month", cohort)
    # whoever is active in the first month is the cohort; its size travels with that month's cell
    founder = F.when(F.col("activity_month") == F.col("cohort_month"), F.col("customer_id"))
    cells = tagged.groupBy("cohort_month", "activity_month").agg(
        F.count(F.lit(1)).alias("active_retained_customers"),
        F.sum("spend").alias("_spend"),
        (F.count(founder) if grain == "customer_id" else F.count_distinct(founder)).alias("_founders"),
    )
    size = F.max("_founders").over(W.partitionBy("cohort_month"))  # one row per month of a cohort
    return (
        cells.withColumn("total_cohort_customers", size)
        .select(
            "cohort_month", "total_cohort_customers", "activity_month", "active_retained_customers",
            percent("active_retained_customers", "total_cohort_customers").alias("retention_rate_pct"),
            F.col("_spend").cast("double").alias("cohort_period_revenue"),
            round_half_up(safe_ratio("_spend", "total_cohort_customers"), 2).alias("avg_revenue_per_cohort_member"),
        )
        .orderBy("cohort_month", "activity_month")
    )


def rfm_metrics(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Recency, frequency and spend of customers through their current version.

    The fact is read once, into a written table of one row per customer version; the last
    day of the warehouse and the metrics both come from that.
    """
    per_key = materialize(
        _dated(fact, dim_date, ["full_date"])
        .groupBy("customer_key")
        .agg(
            F.max("full_date").alias("last_date"),
            F.count_distinct("order_id").alias("frequency_orders"),
            F.sum("net_amount").alias("monetary_spend"),
            F.sum("profit_amount").alias("total_customer_profit"),
        ),
        "rfm",
    )
    last_day = per_key.agg(F.max("last_date")).scalar()
    people = current_only(dim_customer).select(
        "customer_key", "customer_id", full_name("first_name", "last_name").alias("customer_name"), "customer_tier", "city", "country"
    )
    return per_key.join(people, "customer_key").withColumn("recency_days", F.datediff(last_day, F.col("last_date"))).drop("last_date", "customer_key")


def rfm_scores(metrics: DataFrame, high_is_best: bool = False) -> DataFrame:
    """Quartile scores and segment per customer.

    By default the most recent, most frequent and highest spending quarter scores 1;
    ``high_is_best=True`` gives it 4. Ties are settled by customer id.
    """
    tie = ("customer_id", True)
    orders = {
        "r_score": [("recency_days", not high_is_best), tie],
        "f_score": [("frequency_orders", high_is_best), tie],
        "m_score": [("monetary_spend", high_is_best), tie],
    }
    scored = ntile_by_selection(materialize(metrics, "rfm"), 4, orders)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    champion, loyal, recent, risk, lost = SEGMENTS
    segment = (
        F.when((r >= 3) & (f >= 3) & (m >= 3), champion)
        .when((f >= 3) & (m >= 2), loyal)
        .when((r >= 3) & (f <= 2), recent)
        .when((r <= 2) & (f >= 2), risk)
        .otherwise(lost)
    )
    return scored.withColumn("rfm_segment", segment)


def rfm_segments(scores: DataFrame) -> DataFrame:
    """Size, behaviour and revenue per segment."""
    revenue = F.col("total_segment_revenue")
    return (
        scores.groupBy("rfm_segment")
        .agg(
            F.count("customer_id").alias("total_customers"),
            round_half_up(avg_exact("recency_days", 0), 1).alias("avg_days_since_last_order"),
            round_half_up(avg_exact("frequency_orders", 0), 1).alias("avg_orders_per_customer"),
            round_half_up(avg_exact("monetary_spend", 2), 2).alias("avg_customer_spend"),
            sum_money("monetary_spend").alias("total_segment_revenue"),
            sum_money("total_customer_profit").alias("total_segment_profit"),
        )
        .orderBy(revenue.desc())
    )


def customer_churn(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, as_of, by: str = "customer_key") -> DataFrame:
    """Churn score per current customer, customers without orders included.

    Orders count fact rows. By default only facts of the current version count;
    ``by="customer_id"`` counts those of every version.
    """
    spent = (
        _dated(fact, dim_date, ["full_date"])
        .groupBy("customer_key")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("net_amount").alias("spend"), F.max("full_date").alias("last"))
    )
    if by == "customer_id":
        spent = (
            spent.join(dim_customer.select("customer_key", "customer_id"), "customer_key")
            .groupBy("customer_id")
            .agg(F.sum("n").alias("n"), F.sum("spend").alias("spend"), F.max("last").alias("last"))
        )
    people = current_only(dim_customer).select("customer_key", "customer_id", "first_name", "last_name", "customer_tier", "city")
    joined = people.join(spent, by, "left").select(
        people["customer_id"], F.trim(full_name("first_name", "last_name")).alias("customer_name"), "customer_tier", "city",
        F.coalesce("n", F.lit(0)).alias("total_orders"),
        F.coalesce(F.col("spend").cast("double"), F.lit(0.0)).alias("total_spend"),
        F.col("last").alias("last_order_date"),
    )
    return churn_scores(joined, as_of)


def high_risk(scores: DataFrame, n: int = 20) -> DataFrame:
    return top(scores.filter("risk_tier = 'High Risk'"), [F.col("churn_probability_pct").desc(), F.col("customer_id")], n)


def risk_breakdown(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.count_if(F.col("risk_tier") == "High Risk").alias("high_risk"),
        F.count_if(F.col("risk_tier") == "Medium Risk").alias("medium_risk"),
        F.count_if(F.col("risk_tier") == "Low Risk (Loyal)").alias("low_risk"),
    )


def monthly_series(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly revenue, profit, units and orders, keyed by YYYY-MM."""
    return (
        _dated(fact, dim_date, ["year", "month"])
        .groupBy(period_label("year", "month").alias("year_month"))
        .agg(
            sum_money("net_amount").alias("total_net_revenue"),
            sum_money("profit_amount").alias("total_profit"),
            F.sum("quantity").alias("total_units_sold"),
            F.count_distinct("order_id").alias("total_orders"),
        )
    )


def order_outliers(fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_date: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Order lines whose net amount is far from the mean; names are joined to the outliers only."""
    far = zscore_outliers(_dated(fact, dim_date, ["full_date"]), "net_amount", threshold)
    z = F.col("z_score")
    return (
        far.join(dim_customer.select("customer_key", full_name("first_name", "last_name").alias("customer_name")), "customer_key")
        .join(dim_product.select("product_key", "product_name"), "product_key")
        .select(
            "order_id", "order_line_number", "full_date", "customer_name", "product_name", "quantity",
            F.col("net_amount").cast("double").alias("net_amount"),
            round_half_up("mean", 2).alias("avg_transaction_amount"),
            "z_score",
            F.when(z > 0, "High Spender / VIP Surge").otherwise("Abnormal Low Transaction").alias("anomaly_type"),
            F.when(F.abs(z) >= 3.0, "Critical").otherwise("High").alias("severity"),
        )
    )


def vip_orders(fact: DataFrame, dim_customer: DataFrame, order_cols: Sequence[str], threshold: float = 1000.0, rows: int = 3) -> DataFrame:
    """The newest high-value lines with customer name and tier; the limit is taken before the join."""
    named = dim_customer.select("customer_key", full_name("first_name", "last_name").alias("customer_name"), "customer_tier")
    newest = high_value_orders(fact, order_cols, threshold, rows)
    return newest.join(named, "customer_key").select("order_id", "order_line_number", "customer_name", "customer_tier", "net_amount")


# --- stocks, weather, news -----------------------------------------------------------------


def stock_monthly(fact: DataFrame, dim_company: DataFrame, dim_date: DataFrame) -> DataFrame:
    first, best = F.min("open_price"), F.max("close_price")
    return (
        _dated(fact, dim_date, ["year", "month", "month_name"], "date_key")
        .join(current_only(dim_company).select("company_key", "ticker", "company_name"), "company_key")
        .groupBy("year", "month", "month_name", "ticker", "company_name")
        .agg(
            F.count(F.lit(1)).alias("trading_days"),
            round_half_up(avg_exact("close_price"), 4).alias("avg_close_price"),
            round_half_up(F.min("low_price"), 4).alias("monthly_low"),
            round_half_up(F.max("high_price"), 4).alias("monthly_high"),
            F.sum("volume").cast("double").alias("total_volume"),
            round_half_up(avg_exact("daily_return_pct"), 4).alias("avg_daily_return_pct"),
            round_half_up(avg_exact("daily_range_pct"), 4).alias("avg_volatility_pct"),
            round_half_up(safe_ratio(best - first, first, 100.0), 4).alias("monthly_return_pct"),
        )
    )


def stock_kpis(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return _dated(fact, dim_date, ["full_date"], "date_key").agg(
        F.count_distinct("company_key").alias("total_companies"),
        F.count(F.lit(1)).alias("total_trading_records"),
        F.min("full_date").alias("data_from"),
        F.max("full_date").alias("data_to"),
        round_half_up(avg_exact("close_price"), 2).alias("avg_close_price"),
        round_half_up(avg_exact("daily_return_pct"), 4).alias("avg_daily_return_pct"),
        round_half_up(avg_exact("daily_range_pct"), 4).alias("avg_volatility_pct"),
    )


def weather_daily(fact: DataFrame, dim_location: DataFrame, dim_date: DataFrame, dominant: bool = True) -> DataFrame:
    """Daily summary per city; ``dominant=False`` reports 'Clear' without looking at the conditions."""
    keys = ["full_date", "day_name", "month_name", "year", "city", "country_code"]
    rows = _dated(fact, dim_date, keys[:4], "date_key").join(
        dim_location.select("location_key", "city", "country_code"), "location_key"
    )
    daily = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("observation_count"),
        round_half_up(avg_exact("temp_celsius"), 2).alias("avg_temp_c"),
        round_half_up(F.min("temp_min_c"), 2).alias("daily_min_temp_c"),
        round_half_up(F.max("temp_max_c"), 2).alias("daily_max_temp_c"),
        round_half_up(avg_exact("humidity_pct"), 1).alias("avg_humidity_pct"),
        round_half_up(avg_exact("wind_speed_ms"), 2).alias("avg_wind_speed_ms"),
        round_half_up(avg_exact("pressure_hpa"), 0).alias("avg_pressure_hpa"),
        round_half_up(F.sum(F.col("rain_1h_mm").cast("decimal(18,6)")), 2).alias("total_rain_mm"),
        round_half_up(F.sum(F.col("snow_1h_mm").cast("decimal(18,6)")), 2).alias("total_snow_mm"),
    )
    if not dominant:
        return daily.withColumn("dominant_weather", F.lit("Clear"))
    modes = most_frequent(rows, ["full_date", "city", "country_code"], "weather_main", "dominant_weather")
    return daily.join(modes, ["full_date", "city", "country_code"], "left")


def weather_kpis(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count_distinct("location_key").alias("total_cities"),
        F.count(F.lit(1)).alias("total_observations"),
        round_half_up(avg_exact("temp_celsius"), 2).alias("avg_global_temp_c"),
        round_half_up(F.min("temp_celsius"), 2).alias("min_recorded_temp_c"),
        round_half_up(F.max("temp_celsius"), 2).alias("max_recorded_temp_c"),
        round_half_up(avg_exact("humidity_pct"), 1).alias("avg_humidity_pct"),
        round_half_up(avg_exact("wind_speed_ms"), 2).alias("avg_wind_speed_ms"),
    )


def weather_outliers(fact: DataFrame, dim_location: DataFrame, dim_date: DataFrame, threshold: float = 1.5) -> DataFrame:
    """Observations far from their city's mean temperature."""
    rows = _dated(fact, dim_date, ["full_date"], "date_key").join(
        dim_location.select("location_key", "city", "country_code"), "location_key"
    )
    z = F.col("z_score")
    return zscore_outliers(rows, "temp_celsius", threshold, ["city"]).select(
        "full_date", "observation_hour", "city", F.col("country_code").alias("country"), "temp_celsius",
        round_half_up("mean", 1).alias("city_avg_temp"), "z_score",
        F.when(z > 0, "Heatwave (High Temp)").otherwise("Cold Snap (Low Temp)").alias("anomaly_type"),
        F.when(F.abs(z) >= 2.0, "High").otherwise("Moderate").alias("severity"),
        F.col("weather_desc").alias("weather_condition"),
    )


def news_daily(fact: DataFrame, dim_source: DataFrame, dim_date: DataFrame) -> DataFrame:
    with_image = sum_if(F.col("has_image"))
    return (
        _dated(fact, dim_date, ["full_date", "day_name", "year", "month"], "date_key")
        .join(dim_source.select("source_key", "source_name"), "source_key")
        .groupBy("full_date", "day_name", "year", "month", "topic", "source_name")
        .agg(
            F.count(F.lit(1)).alias("article_count"),
            round_half_up(avg_exact("title_word_count", 0), 1).alias("avg_title_length"),
            with_image.alias("articles_with_images"),
            percent(with_image, F.count(F.lit(1)), 1).alias("image_coverage_pct"),
        )
    )


def news_kpis(fact: DataFrame) -> DataFrame:
    """Counts and coverage; the two distinct counts run over counts per (source, topic), not over articles."""
    cells = fact.groupBy("source_key", "topic").agg(
        F.count(F.lit(1)).alias("n"), F.sum("title_word_count").alias("words"), sum_if(F.col("has_image")).alias("images")
    )
    return cells.agg(
        F.sum("n").alias("total_articles"),
        F.count_distinct("source_key").alias("total_sources"),
        F.count_distinct("topic").alias("total_topics"),
        round_half_up(safe_ratio(F.sum("words"), F.sum("n")), 1).alias("avg_title_length"),
        F.sum("images").alias("articles_with_images"),
    )


def top_sources(fact: DataFrame, dim_source: DataFrame, n: int = 10) -> DataFrame:
    named = fact.join(dim_source.select("source_key", "source_name"), "source_key")
    return top_groups(named, ["source_name"], F.count(F.lit(1)), "article_count", n)


def news_sentiment(fact: DataFrame, positive: Sequence[str], negative: Sequence[str], text: str = "title") -> DataFrame:
    return sentiment_by(sentiment(fact, text, positive, negative), "topic")


def cross_domain_daily(dim_date: DataFrame, stocks: DataFrame, weather: DataFrame, news: DataFrame) -> DataFrame:
    """One row per day on which any domain has facts; absent domains count as 0.

    Every fact is reduced to one row per day before it meets the calendar.
    """
    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    s = stocks.groupBy("date_key").agg(
        round_half_up(avg_exact("close_price"), 4).alias("stocks_avg_close"),
        F.sum("volume").alias("stocks_total_volume"),
        round_half_up(avg_exact("daily_return_pct"), 4).alias("stocks_avg_return_pct"),
    )
    w = weather.groupBy("date_key").agg(
        round_half_up(avg_exact("temp_celsius"), 2).alias("weather_avg_temp_c"),
        round_half_up(avg_exact("humidity_pct"), 1).alias("weather_avg_humidity_pct"),
    )
    n = news.groupBy("date_key").agg(F.count(F.lit(1)).alias("news_article_count"))
    spine = dim_date.select("date_key", "full_date", "day_name", "month_name", "year", "quarter")
    measures = [
        "stocks_avg_close", "stocks_total_volume", "stocks_avg_return_pct",
        "weather_avg_temp_c", "weather_avg_humidity_pct", "news_article_count",
    ]
    return spine_join(spine, "date_key", s, w, n).select(
        "full_date", "day_name", "month_name", "year", "quarter", *[or_zero(m) for m in measures]
    )


# --- finance, fitness, media ---------------------------------------------------------------


def finance_summary(fact: DataFrame) -> DataFrame:
    def or_zero(value: Column) -> Column:
        return F.coalesce(value, F.lit(0.0))

    return fact.agg(
        F.count("transaction_key").alias("total_transactions"),
        or_zero(sum_money("amount")).alias("total_spend"),
        or_zero(round_half_up(avg_exact("amount", 2), 2)).alias("avg_transaction_amount"),
        or_zero(F.max("amount").cast("double")).alias("max_single_transaction"),
    )


def breakdown(dim: DataFrame, fact: DataFrame, key: str, by: Sequence[str], measures: dict[str, Column], how: str = "left") -> DataFrame:
    """Totals per dimension member; ``how="left"`` keeps members without facts.

    `measures` are aggregates over the fact, computed per key before the join; a missing one becomes 0.
    """
    per_key = fact.groupBy(key).agg(*[m.alias(n) for n, m in measures.items()])
    return dim.join(per_key, key, how).groupBy(*by).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in measures]
    )


def finance_by_category(dim: DataFrame, fact: DataFrame) -> DataFrame:
    measures = {"transaction_count": F.count("transaction_key"), "category_total_spend": F.sum("amount")}
    out = breakdown(dim, fact, "category_key", ["category_name", "category_type"], measures)
    return out.withColumn("category_total_spend", F.col("category_total_spend").cast("double"))


def fitness_summary(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("workout_key").alias("total_workouts"),
        F.coalesce(F.sum("duration_minutes"), F.lit(0)).alias("total_duration_minutes"),
        F.coalesce(F.sum("calories_burned"), F.lit(0)).alias("total_calories_burned"),
        F.coalesce(round_half_up(avg_exact("duration_minutes", 0), 1), F.lit(0.0)).alias("avg_workout_duration_min"),
    )


def fitness_by_type(dim: DataFrame, fact: DataFrame) -> DataFrame:
    measures = {
        "total_sessions": F.count("workout_key"),
        "total_minutes": F.sum("duration_minutes"),
        "total_calories": F.sum("calories_burned"),
    }
    return breakdown(dim, fact, "workout_type_key", ["workout_name", "workout_category"], measures)


def media_summary(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("log_key").alias("total_items_consumed"),
        F.coalesce(round_half_up(avg_exact("rating"), 2), F.lit(0.0)).alias("avg_rating"),
    )


def media_by_type(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Types with at least one log entry; the mean is taken over all entries of the type."""
    exact = F.col("rating").cast("decimal(18,6)")
    measures = {"items_logged": F.count("log_key"), "_sum": F.sum(exact), "_rated": F.count("rating")}
    out = breakdown(dim, fact, "media_key", ["media_type"], measures, how="inner")
    mean = F.coalesce(round_half_up(safe_ratio("_sum", "_rated"), 2), F.lit(0.0))
    return out.select("media_type", "items_logged", mean.alias("avg_type_rating"))
