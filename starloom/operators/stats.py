"""Outliers, scoring, smoothing and lexicon statistics as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import months_after, next_weekdays
from ..functions.numbers import as_column, avg_exact, clamp, round_half_up, truncate_to_int
from ..functions.text import matches, token_set

# Default sentiment lexicons and scores.
POSITIVE_WORDS = ("breakthrough", "surge", "record", "rebound", "growth", "highs", "funding", "success", "cut", "stabilize")
NEGATIVE_WORDS = ("warn", "vulnerability", "risk", "drop", "decline", "fall", "threat", "crisis", "slump")
SENTIMENT_SCORE = 0.65
SENTIMENT_MARGIN = 0.1

# Churn score weights, horizons and tiers.
CHURN_WEIGHTS = {"recency": 0.5, "frequency": 0.3, "monetary": 0.2}
CHURN_DAYS, CHURN_ORDERS, CHURN_SPEND = 120.0, 10.0, 5000.0
CHURN_NO_ORDER_DAYS = 180
CHURN_RANGE = (5.0, 99.9)
CHURN_HIGH, CHURN_MEDIUM = 70.0, 40.0

# Smoothing parameters and bands.
REVENUE_ALPHA, REVENUE_BETA = 0.5, 0.3
REVENUE_PROFIT_SHARE, REVENUE_LOWER, REVENUE_UPPER = 0.45, 0.88, 1.12
PRICE_ALPHA, PRICE_BETA = 0.4, 0.2
PRICE_HOLT_SHARE, PRICE_LINE_SHARE = 0.6, 0.4
PRICE_DEFAULT_VOLATILITY = 2.0
PRICE_MIN_ROWS = 5
Z_95 = 1.96


def _spread(std: Column) -> Column:
    """Population deviation, 1 where it is 0 or undefined."""
    return F.when(F.coalesce(std, F.lit(0.0)) == 0, 1.0).otherwise(std)


def _scored(df: DataFrame, value: str, threshold: float) -> DataFrame:
    z = round_half_up((F.col(value).cast("double") - F.col("mean")) / F.col("std"), 2)
    return df.withColumn("z_score", z).filter(F.abs("z_score") >= threshold)


def zscore_outliers(df: DataFrame, value: str, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    """Rows at least `threshold` population deviations from the mean of their group (or of all rows).

    Mean and deviation are grouped aggregates joined back on the key, so a hot group is
    reduced on the map side and its rows stay spread; the score is rounded before the test.
    """
    stats = [
        avg_exact(value).alias("mean"),
        _spread(F.stddev_pop(F.col(value).cast("double"))).alias("std"),
    ]
    if keys:
        return _scored(df.join(df.groupBy(*keys).agg(*stats), list(keys)), value, threshold)
    summary = df.agg(*stats).agg(F.first(F.struct("mean", "std"))).scalar()
    placed = df.withColumns({"mean": summary["mean"], "std": summary["std"]})
    return _scored(placed, value, threshold)


def scale_to_100(df: DataFrame, specs: dict[str, tuple[str, str]]) -> DataFrame:
    """Columns scaled to 0..100 over the whole frame.

    specs: output -> (column, "max" for x/max or "range" for (x-min)/(max-min)).
    """
    ends = []
    for column, _ in specs.values():
        ends += [F.max(column).cast("double").alias(f"{column}_max"), F.min(column).cast("double").alias(f"{column}_min")]
    ends_row = df.agg(*ends)
    summary = ends_row.agg(F.first(F.struct(*ends_row.columns))).scalar()
    out = {}
    for name, (column, kind) in specs.items():
        value, high, low = F.col(column).cast("double"), summary[f"{column}_max"], summary[f"{column}_min"]
        if kind == "max":
            out[name] = F.when(high > 0, round_half_up(value / high * 100, 4))
        else:
            out[name] = F.when(high > low, round_half_up((value - low) / (high - low) * 100, 4))
    return df.withColumns(out)


def churn_scores(customers: DataFrame, as_of) -> DataFrame:
    """Churn probability and tier from total_orders, total_spend and last_order_date."""
    today = F.lit(as_of).cast("date")
    days = F.coalesce(F.datediff(today, F.col("last_order_date")), F.lit(CHURN_NO_ORDER_DAYS))
    recency = clamp(F.col("days_since_last_order") / CHURN_DAYS, high=1.0)
    frequency = clamp(1.0 - F.col("total_orders") / CHURN_ORDERS, low=0.0)
    monetary = clamp(1.0 - F.col("total_spend") / CHURN_SPEND, low=0.0)
    w = CHURN_WEIGHTS
    score = (w["recency"] * recency + w["frequency"] * frequency + w["monetary"] * monetary) * 100
    p = F.col("churn_probability_pct")
    return (
        customers.withColumn("days_since_last_order", days)
        .withColumn("churn_probability_pct", clamp(round_half_up(score, 1), *CHURN_RANGE))
        .withColumn(
            "risk_tier",
            F.when(p >= CHURN_HIGH, "High Risk").when(p >= CHURN_MEDIUM, "Medium Risk").otherwise("Low Risk (Loyal)"),
        )
    )


def holt_fit(series: Column, alpha: float, beta: float, trend: str) -> Column:
    """Level and trend after double exponential smoothing of an array of DOUBLE.

    trend "mean" starts with (last - first) / (n - 1), "step" with the first difference.
    """
    n = F.size(series)
    first = F.element_at(series, 1)
    if trend == "mean":
        start = (F.element_at(series, -1) - first) / F.greatest(F.lit(1), n - 1)
    elif trend == "step":
        start = F.try_element_at(series, F.lit(2)) - first
    else:
        raise ValueError(f"trend must be 'mean' or 'step', not {trend!r}")
    state = F.named_struct(F.lit("level"), first, F.lit("trend"), F.coalesce(start, F.lit(0.0)))

    def step(s: Column, x: Column) -> Column:
        level = alpha * x + (1 - alpha) * (s["level"] + s["trend"])
        trend = beta * (level - s["level"]) + (1 - beta) * s["trend"]
        return F.named_struct(F.lit("level"), level, F.lit("trend"), trend)

    return F.aggregate(F.slice(series, F.lit(2), F.greatest(n, F.lit(1))), state, step)


def collect_series(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """One ordered array of (order, *columns) per key.

    For series that already have one row per key and calendar period: their length is
    bounded by the calendar, not by the data.
    """
    points = F.array_sort(F.collect_list(F.struct(order, *columns)))
    return df.groupBy(*keys).agg(points.alias("points"))


def _values(column: str) -> Column:
    return F.transform("points", lambda p: p[column].cast("double"))


def revenue_forecast(monthly: DataFrame, horizon: int = 3) -> DataFrame:
    """Net revenue and unit forecasts for the next months from (year_month, revenue, units); empty below two months."""
    series = collect_series(monthly, [], "year_month", ["total_net_revenue", "total_units_sold"])
    fitted = series.filter(F.size("points") >= 2).select(
        F.element_at("points", -1)["year_month"].alias("last_month"),
        F.size("points").alias("months_analyzed"),
        holt_fit(_values("total_net_revenue"), REVENUE_ALPHA, REVENUE_BETA, "mean").alias("revenue"),
        holt_fit(_values("total_units_sold"), REVENUE_ALPHA, REVENUE_BETA, "mean").alias("units"),
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"),
    )
    step = F.col("step")
    revenue = round_half_up(clamp(F.col("revenue.level") + step * F.col("revenue.trend"), low=0.0), 2)
    units = truncate_to_int(clamp(F.col("units.level") + step * F.col("units.trend"), low=1.0))
    forecast = fitted.select(
        months_after("last_month", step).alias("year_month"),
        step.alias("forecast_month_step"),
        revenue.alias("predicted_net_revenue"),
        units.alias("predicted_units_sold"),
        "months_analyzed",
    )
    p = F.col("predicted_net_revenue")
    return forecast.withColumns(
        {
            "predicted_profit": round_half_up(p * REVENUE_PROFIT_SHARE, 2),
            "confidence_lower_95": round_half_up(clamp(p * REVENUE_LOWER, low=0.0), 2),
            "confidence_upper_95": round_half_up(p * REVENUE_UPPER, 2),
        }
    )


def price_forecast(bars: DataFrame, horizon: int = 14, key: str = "ticker", day: str = "trade_date") -> DataFrame:
    """Close forecasts for the next weekdays of every key with at least five bars.

    `bars` has one row per key and day with close_price and daily_return_pct. The line fit is
    solved from sums over the same ordered array, so a key is handled in one pass.
    """
    series = collect_series(bars, [key], day, ["close_price", "daily_return_pct"])
    series = series.filter(F.size("points") >= PRICE_MIN_ROWS)
    price = F.transform("points", lambda p: p["close_price"].cast("double"))
    returns = F.filter(_values("daily_return_pct"), lambda r: r.isNotNull())

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    fitted = series.withColumns({"_prices": price, "_returns": returns}).withColumn("_n", F.size("_prices").cast("double"))
    # least squares over x = 0..n-1
    n = F.col("_n")
    sum_y = total(F.col("_prices"))
    sum_xy = total(F.transform("_prices", lambda y, i: y * i))
    sum_x, sum_xx = n * (n - 1) / 2, (n - 1) * n * (2 * n - 1) / 6
    slope = (n * sum_xy - sum_x * sum_y) / (n * sum_xx - sum_x * sum_x)
    mean_r = total(F.col("_returns")) / F.size("_returns")
    spread = F.sqrt(total(F.transform("_returns", lambda r: (r - F.col("_mean_r")) * (r - F.col("_mean_r")))) / F.size("_returns"))
    fitted = fitted.withColumns(
        {
            "_holt": holt_fit(F.col("_prices"), PRICE_ALPHA, PRICE_BETA, "step"),
            "_slope": slope,
            "_mean_r": F.when(F.size("_returns") > 0, mean_r),
            "_sum_y": sum_y,
            "_last_day": F.element_at("points", -1)[day],
            "_last": F.element_at("_prices", -1),
        }
    ).withColumns(
        {
            "_intercept": (F.col("_sum_y") - F.col("_slope") * sum_x) / n,
            "_vol": F.when(F.size("_returns") > 0, spread).otherwise(F.lit(PRICE_DEFAULT_VOLATILITY)),
        }
    )
    days = fitted.select(
        key, "_n", "_holt", "_slope", "_intercept", "_vol", "_last",
        F.posexplode(next_weekdays("_last_day", horizon)).alias("_pos", "forecast_date"),
    ).withColumn("horizon_day", F.col("_pos") + 1)
    h = F.col("horizon_day")
    blend = PRICE_HOLT_SHARE * (F.col("_holt.level") + h * F.col("_holt.trend")) + PRICE_LINE_SHARE * (
        F.col("_intercept") + (n + h - 1) * F.col("_slope")
    )
    predicted = days.withColumn("predicted_close", round_half_up(blend, 2))
    p = F.col("predicted_close")
    margin = round_half_up(p * (F.col("_vol") / 100.0) * F.sqrt(h) * Z_95, 2)
    return predicted.withColumn("_margin", margin).select(
        key, "forecast_date", "horizon_day", "predicted_close",
        round_half_up(p + F.col("_margin"), 2).alias("upper_bound_95"),
        round_half_up(clamp(p - F.col("_margin"), low=1.0), 2).alias("lower_bound_95"),
        round_half_up((p - F.col("_last")) / F.col("_last") * 100, 2).alias("predicted_change_pct"),
        round_half_up("_vol", 2).alias("expected_volatility_pct"),
        F.when(F.col("_slope") > 0, "Bullish").otherwise("Bearish").alias("trend_direction"),
    )


def sentiment(df: DataFrame, text: str, positive: Sequence[str] = POSITIVE_WORDS, negative: Sequence[str] = NEGATIVE_WORDS) -> DataFrame:
    """Label and score of a text from the distinct lexicon words in it."""
    scored = df.withColumn("_tokens", token_set(F.coalesce(as_column(text), F.lit(""))))
    up, down = matches(F.col("_tokens"), positive), matches(F.col("_tokens"), negative)
    return scored.withColumns(
        {
            "sentiment_label": F.when(up > down, "Positive").when(down > up, "Negative").otherwise("Neutral"),
            "sentiment_score": F.when(up > down, SENTIMENT_SCORE).when(down > up, -SENTIMENT_SCORE).otherwise(0.0),
        }
    ).drop("_tokens")


def sentiment_by(df: DataFrame, key: str) -> DataFrame:
    """Counts per label, mean score and overall direction per topic."""
    def labelled(label: str) -> Column:
        return F.count_if(F.col("sentiment_label") == label)

    score = F.col("avg_sentiment_score")
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("article_count"),
        labelled("Positive").alias("positive_count"),
        labelled("Negative").alias("negative_count"),
        labelled("Neutral").alias("neutral_count"),
        round_half_up(avg_exact("sentiment_score", 2), 2).alias("avg_sentiment_score"),
    ).withColumn(
        "overall_sentiment",
        F.when(score > SENTIMENT_MARGIN, "Bullish").when(score < -SENTIMENT_MARGIN, "Bearish").otherwise("Neutral"),
    )
