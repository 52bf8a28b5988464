"""Derived measures of the fact tables and their eligibility rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..functions.numbers import MONEY, as_column, round_half_up, safe_ratio
from ..functions.text import has_text, slug, word_count

# Accepted temperature range and alert threshold.
TEMP_RANGE = (-90.0, 60.0)
HIGH_VALUE = 1000.0
HIGH_VALUE_ROWS = 3


def sales_measures(df: DataFrame, zero_net: str = "null") -> DataFrame:
    """Amounts of an order line from quantity, unit_price, discount, tax and cost_price.

    The margin of a line with net 0 is NULL; ``zero_net="zero"`` gives 0 for every net <= 0.
    """
    gross = F.col("quantity") * F.col("unit_price")
    net = gross - F.col("discount_amount") + F.col("tax_amount")
    cost = F.col("quantity") * F.col("cost_price")
    margin = round_half_up(safe_ratio("profit_amount", "net_amount", 100.0), 2)
    if zero_net == "zero":
        margin = F.when(F.col("net_amount") > 0, margin).otherwise(F.lit(0.0))
    elif zero_net != "null":
        raise ValueError(f"zero_net must be 'null' or 'zero', not {zero_net!r}")
    amounts = {
        "gross_amount": gross,
        "discount_amount": F.col("discount_amount"),
        "tax_amount": F.col("tax_amount"),
        "net_amount": net,
        "cost_amount": cost,
        "profit_amount": net - cost,
    }
    return df.withColumns({k: F.round(v, 2).cast(MONEY) for k, v in amounts.items()}).withColumn("profit_margin_pct", margin)


def bar_measures(bars: DataFrame, key: str = "ticker", day: str = "trade_date") -> DataFrame:
    """Daily return, range and average price; the first bar of a key has no return.

    One row per key and day, so a key's window is bounded by the calendar.
    """
    previous = F.lag("close_price").over(W.partitionBy(key).orderBy(day))
    price_range = F.col("high_price") - F.col("low_price")
    total = F.col("open_price") + F.col("high_price") + F.col("low_price") + F.col("close_price")
    return bars.withColumn("_previous", previous).withColumns(
        {
            "daily_return_pct": round_half_up(safe_ratio(F.col("close_price") - F.col("_previous"), "_previous", 100.0), 4),
            "daily_range": round_half_up(price_range, 4),
            "daily_range_pct": round_half_up(safe_ratio(price_range, "low_price", 100.0), 4),
            "avg_price": round_half_up(total / 4, 4),
        }
    ).drop("_previous")


def article_measures(articles: DataFrame) -> DataFrame:
    return articles.withColumns(
        {
            "title_word_count": word_count("title"),
            "has_image": has_text("url_to_image"),
            "published_hour": F.hour("published_at"),
            "date_key": date_key("published_at"),
        }
    )


def source_identifier() -> Column:
    """The given source id, else a slug of the source name."""
    return F.coalesce(F.nullif("source_id", F.lit("")), slug("source_name"))


def eligible_bars() -> Column:
    return (F.col("close_price") > 0) & (F.col("volume") >= 0)


def eligible_observations(low: float = TEMP_RANGE[0], high: float = TEMP_RANGE[1]) -> Column:
    return F.col("temp_celsius").between(low, high)


def eligible_articles() -> Column:
    return has_text("title") & F.col("published_at").isNotNull()


def by_value(df: DataFrame, column: str, value: str | None, everything: str = "All") -> DataFrame:
    """Rows with one dimension value, or all of them."""
    if value is None or value == everything:
        return df
    return df.filter(F.col(column) == value)


def high_value_orders(
    sales: DataFrame, order_cols: Sequence[str], threshold: float = HIGH_VALUE, rows: int = HIGH_VALUE_ROWS
) -> DataFrame:
    """The newest order lines at or above the threshold."""
    newest = [F.col(c).desc() for c in order_cols]
    return sales.filter(F.col("net_amount") >= threshold).orderBy(*newest).limit(rows)


def high_value_alerts(orders: DataFrame) -> DataFrame:
    """Alert rows for high-value orders (order_id, customer_name, customer_tier, net_amount)."""
    amount = F.concat(F.lit("$"), F.format_number(as_column("net_amount").cast("decimal(28,2)"), 2))
    return orders.select(
        F.lit("vip").alias("alert_type"),
        F.concat(F.lit("High-Value VIP Order Detected: "), amount).alias("title"),
        F.concat(
            F.lit("Order '"), "order_id", F.lit("' placed by customer '"), "customer_name",
            F.lit("' ("), "customer_tier", F.lit(" Tier) for "), amount, F.lit(" net revenue."),
        ).alias("message"),
        "order_id", "customer_name", "customer_tier", "net_amount",
    )
