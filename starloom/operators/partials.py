"""Aggregates that add up: partial sums and distinct-member bitmaps that are stored per load and merged without the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def member_bitmaps(rows: DataFrame, keys: Sequence[str], member: str, out: str = "members") -> DataFrame:
    """(keys, bucket, members): which non-negative integer members occur, a bit each, 32,768 members a bucket."""
    placed = rows.where(F.col(member).isNotNull()).withColumn("bucket", F.bitmap_bucket_number(member))
    return placed.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(member)).alias(out))


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[str | Column], members: str = "members") -> DataFrame:
    """Bitmaps of coarser keys (months from days, one mart from many loads), or-ed bucket by bucket."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg(members).alias(members))


def distinct_members(bitmaps: DataFrame, keys: Sequence[str], out: str, members: str = "members") -> DataFrame:
    """Exact distinct counts per key from merged bitmaps."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count(members)).alias(out))


def sales_partials(fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a load adds to the monthly sales mart: (month, lines, net_amount, profit_amount) and the bitmaps of its customers per month."""
    monthly = fact.withColumn("month_key", F.floor(F.col("order_date_key") / 100).cast("int"))
    sums = monthly.groupBy("month_key").agg(
        F.count(F.lit(1)).alias("lines"),
        *[F.sum(c).cast("decimal(28,2)").alias(c) for c in ("net_amount", "profit_amount")],
    )
    return sums, member_bitmaps(monthly, ["month_key"], "customer_key")


def monthly_sales(sums: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The mart from the partials of all loads; a load of late lines only adds rows of the months it touches."""
    totals = sums.groupBy("month_key").agg(*[F.sum(c).alias(c) for c in ("lines", "net_amount", "profit_amount")])
    active = distinct_members(merged_bitmaps(bitmaps, ["month_key"]), ["month_key"], "active_customers")
    return totals.join(active, "month_key", "left").withColumn("active_customers", F.coalesce("active_customers", F.lit(0).cast("bigint")))
