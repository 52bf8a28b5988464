"""Date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D

# Default calendar ranges of the batch and the real-time warehouse.
BATCH_RANGE = ("2024-01-01", "2026-12-31")
REALTIME_RANGE = ("2020-01-01", "2030-12-31")

CORE_COLUMNS = (
    "date_key", "full_date", "day_name", "day_of_week", "day_of_month",
    "month", "month_name", "quarter", "year", "is_weekend",
)


def date_dim(
    spark: SparkSession,
    start: str = REALTIME_RANGE[0],
    end: str = REALTIME_RANGE[1],
    week_start: str = "iso",
    fiscal_start_month: int = 4,
) -> DataFrame:
    """One row per day of [start, end]; size depends on the calendar only."""
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    days = spark.range(1).select(F.explode(span).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        D.date_key(d).alias("date_key"),
        d,
        D.day_name(d).alias("day_name"),
        D.day_of_week(d, week_start).alias("day_of_week"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month"),
        D.month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        D.is_weekend(d).alias("is_weekend"),
        D.is_month_start(d).alias("is_month_start"),
        D.is_month_end(d).alias("is_month_end"),
        D.fiscal_quarter(d, fiscal_start_month).alias("fiscal_quarter"),
        D.fiscal_year(d, fiscal_start_month).alias("fiscal_year"),
    )


def core_date_dim(spark: SparkSession, start: str = BATCH_RANGE[0], end: str = BATCH_RANGE[1]) -> DataFrame:
    """The ten-column calendar with Sunday as day 1."""
    return date_dim(spark, start, end, week_start="sunday").select(*CORE_COLUMNS)
