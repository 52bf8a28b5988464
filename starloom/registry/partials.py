"""Marts and distinct counts from stored partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.partials import distinct_members, member_bitmaps, merged_bitmaps, monthly_sales, sales_partials
from ..session import materialize, scratch_path
from ..sources.store import TableStore
from . import sql as S
from .core import query
from .reports import sales

_MONTH = "CAST(floor(order_date_key / 100) AS BIGINT)"


@query("distinct_from_bitmaps", S.with_(*S.SALES, select=f"""
SELECT 'month' AS grain, {_MONTH} AS period, COUNT(DISTINCT customer_key) AS customers FROM fact_sales GROUP BY 2
UNION ALL SELECT 'year', CAST(floor(order_date_key / 10000) AS BIGINT), COUNT(DISTINCT customer_key) FROM fact_sales GROUP BY 2
UNION ALL SELECT 'all', 0, COUNT(DISTINCT customer_key) FROM fact_sales"""))
def distinct_from_bitmaps(spark, sf_dir) -> DataFrame:
    """Distinct customers of months, years and the whole from stored bitmaps of days; the fact is read once."""
    days = materialize(member_bitmaps(sales(spark, sf_dir).fact_sales, ["order_date_key"], "customer_key"), "bitmaps")
    out = None
    for grain, period in (("month", F.floor(F.col("order_date_key") / 100)), ("year", F.floor(F.col("order_date_key") / 10000)), ("all", F.lit(0))):
        merged = merged_bitmaps(days.withColumn("period", period.cast("bigint")), ["period"])
        counted = distinct_members(merged, ["period"], "customers").select(F.lit(grain).alias("grain"), "period", "customers")
        out = counted if out is None else out.unionByName(counted)
    return out


@query("mart_by_deltas", S.with_(*S.SALES, select=f"""
SELECT {_MONTH} AS month_key, COUNT(*) AS lines, {S.total('net_amount')} AS net_amount, {S.total('profit_amount')} AS profit_amount,
  COUNT(DISTINCT customer_key) AS active_customers, (SELECT COUNT(DISTINCT {_MONTH}) FROM fact_sales WHERE quantity > 40 AND order_date_key < 19970101) AS months_of_late_load
FROM fact_sales GROUP BY 1"""))
def mart_by_deltas(spark, sf_dir) -> DataFrame:
    """The monthly mart from the partials of three loads, the last one of late lines: equal to a rebuild, and the late load adds rows of its months only."""
    fact = materialize(sales(spark, sf_dir).fact_sales, "fact")
    late = (F.col("quantity") > 40) & (F.col("order_date_key") < 19970101)
    store = TableStore(spark, scratch_path(spark, "mart"))
    for batch in (fact.where(~late & (F.col("order_date_key") < 19980101)), fact.where(~late & (F.col("order_date_key") >= 19980101)), fact.where(late)):
        txn = store.begin()
        sums, bitmaps = sales_partials(batch)
        added = txn.append("mart_sales_sums", sums)
        txn.append("mart_sales_members", bitmaps)
        txn.commit()
    mart = monthly_sales(store.read("mart_sales_sums"), store.read("mart_sales_members"))
    return mart.withColumn("months_of_late_load", added.agg(F.count(F.lit(1))).scalar())
