import math
from datetime import date, timedelta

import numpy as np
from pyspark.sql import functions as F

from starloom.operators import stats as S


def holt(xs, alpha, beta, trend):
    level = xs[0]
    for x in xs[1:]:
        last = level
        level = alpha * x + (1 - alpha) * (level + trend)
        trend = beta * (level - last) + (1 - beta) * trend
    return level, trend


def test_holt_fold(spark):
    xs = [10.0, 12.0, 11.5, 15.0, 14.0]
    df = spark.createDataFrame([(xs,)], "s array<double>")
    for kind, start in (("mean", (xs[-1] - xs[0]) / 4), ("step", xs[1] - xs[0])):
        got = df.select(S.holt_fit(F.col("s"), 0.4, 0.2, kind).alias("h")).first().h
        assert np.allclose((got.level, got.trend), holt(xs, 0.4, 0.2, start))


def test_revenue_forecast_needs_two_months(spark):
    schema = "year_month string, total_net_revenue double, total_units_sold bigint"
    assert S.revenue_forecast(spark.createDataFrame([("2024-12", 5.0, 1)], schema)).count() == 0
    two = spark.createDataFrame([("2024-12", 500.0, 10), ("2024-11", 1000.0, 20)], schema)
    rows = S.revenue_forecast(two, 3).orderBy("forecast_month_step").collect()
    level, trend = holt([1000.0, 500.0], 0.5, 0.3, -500.0)
    assert [r.year_month for r in rows] == ["2025-01", "2025-02", "2025-03"]
    assert rows[0].predicted_net_revenue == round(max(0.0, level + trend), 2)
    assert rows[2].predicted_net_revenue == 0.0 and rows[2].predicted_units_sold == 1
    assert rows[0].predicted_profit == round(rows[0].predicted_net_revenue * 0.45, 2)


def test_price_forecast_against_numpy(spark):
    prices = [100.0, 101.5, 99.0, 103.25, 104.0, 102.5]
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(6)]  # ends on a Saturday
    returns = [None] + [round((b - a) / a * 100, 4) for a, b in zip(prices, prices[1:])]
    data = [("T", d, p, r) for d, p, r in zip(days, prices, returns)] + [("FEW", days[0], 1.0, None)]
    bars = spark.createDataFrame(data, "ticker string, trade_date date, close_price double, daily_return_pct double")
    got = S.price_forecast(bars, 3).orderBy("horizon_day").collect()
    slope, intercept = np.polyfit(np.arange(6), prices, 1)
    level, trend = holt(prices, 0.4, 0.2, prices[1] - prices[0])
    vol = float(np.std([r for r in returns if r is not None]))
    assert {r.ticker for r in got} == {"T"}
    assert [str(r.forecast_date) for r in got] == ["2024-01-08", "2024-01-09", "2024-01-10"]
    for r in got:
        h = r.horizon_day
        p = round(0.6 * (level + h * trend) + 0.4 * (intercept + (6 + h - 1) * slope), 2)
        margin = round(p * vol / 100 * math.sqrt(h) * 1.96, 2)
        assert abs(r.predicted_close - p) < 0.011
        assert abs(r.upper_bound_95 - (p + margin)) < 0.03 and abs(r.lower_bound_95 - (p - margin)) < 0.03
        assert r.trend_direction == "Bullish"


def test_group_outliers_with_constant_and_single_groups(spark, rows):
    data = [("a", float(v)) for v in (1, 1, 1, 1, 1, 1, 1, 1, 1, 10)] + [("same", 5.0), ("same", 5.0), ("one", 9.0)]
    df = spark.createDataFrame(data, "g string, v double")
    assert rows(S.zscore_outliers(df, "v", 2.0, ["g"]), "g", "v", "z_score") == [("a", 10.0, 3.0)]
    assert S.zscore_outliers(df.filter("g = 'one'"), "v", 0.5).count() == 0


def test_churn_tiers(spark):
    schema = "customer_id string, total_orders bigint, total_spend double, last_order_date date"
    df = spark.createDataFrame([("new", 0, 0.0, None), ("loyal", 50, 9e9, date(2024, 6, 1)), ("mid", 5, 2500.0, date(2024, 4, 2))], schema)
    got = {r.customer_id: (r.days_since_last_order, r.churn_probability_pct, r.risk_tier) for r in S.churn_scores(df, "2024-06-01").collect()}
    assert got == {"new": (180, 99.9, "High Risk"), "loyal": (0, 5.0, "Low Risk (Loyal)"), "mid": (60, 50.0, "Medium Risk")}


def test_sentiment_uses_distinct_words(spark, rows):
    df = spark.createDataFrame([("t", "Record drop drop"), ("t", "Surge in growth"), ("u", None), ("t", "crisis")], "topic string, title string")
    labelled = S.sentiment(df, "title")
    assert rows(labelled, "sentiment_label") == [("Negative",), ("Neutral",), ("Neutral",), ("Positive",)]
    by = {r.topic: r for r in S.sentiment_by(labelled, "topic").collect()}
    assert (by["t"].article_count, by["t"].avg_sentiment_score, by["t"].overall_sentiment) == (3, 0.0, "Neutral")


def test_scaling(spark, rows):
    df = spark.createDataFrame([(1, 10), (2, 20), (4, 20)], "a int, b int")
    assert rows(S.scale_to_100(df, {"x": ("a", "max"), "y": ("b", "range")}), "x", "y") == [(100.0, 100.0), (25.0, 0.0), (50.0, 100.0)]
