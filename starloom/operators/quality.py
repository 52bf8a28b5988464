"""Declarative data-quality checks, one result row per check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Check:
    """A check on one table. `kind` is "rows" (condition marks a bad row), "unique" or "reference"."""

    table: str
    name: str
    kind: str = "rows"
    condition: Column | None = None
    columns: tuple[str, ...] = ()
    parent: str | None = None
    parent_column: str | None = None
    severity: str = "critical"
    type: str = "constraint"


def not_null(table: str, column: str, severity: str = "critical") -> Check:
    return Check(table, f"not_null_{column}", condition=F.col(column).isNull(), severity=severity, type="null_check")


def not_blank(table: str, column: str, severity: str = "critical") -> Check:
    bad = F.col(column).isNull() | (F.trim(column) == "")
    return Check(table, f"not_null_{column}", condition=bad, severity=severity, type="null_check")


def accepted_values(table: str, column: str, values: Sequence[str], severity: str = "critical") -> Check:
    bad = F.col(column).isNotNull() & ~F.col(column).isin(*values)
    return Check(table, f"accepted_values_{column}", condition=bad, severity=severity, type="accepted_values")


def in_range(table: str, column: str, low=None, high=None, severity: str = "critical", name: str | None = None) -> Check:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return Check(table, name or f"range_{column}", condition=F.coalesce(bad, F.lit(False)), severity=severity, type="range_check")


def unique(table: str, *columns: str, severity: str = "critical") -> Check:
    return Check(table, "unique_" + "_".join(columns), "unique", columns=columns, severity=severity, type="unique")


def relationship(table: str, column: str, parent: str, parent_column: str | None = None, severity: str = "critical", name: str | None = None) -> Check:
    return Check(
        table, name or f"relationships_{column}_{parent}", "reference", columns=(column,), parent=parent,
        parent_column=parent_column or column, severity=severity, type="relationships",
    )


# Accepted customer tiers.
CUSTOMER_TIERS = ("Standard", "Bronze", "Silver", "Gold", "Platinum")

# The declared column tests of the staging, core and reporting layers.
def layer_checks() -> list[Check]:
    return [
        not_null("stg_customers", "customer_id"),
        not_null("stg_customers", "email"),
        accepted_values("stg_customers", "customer_tier", CUSTOMER_TIERS),
        not_null("stg_products", "product_id"),
        unique("stg_products", "product_id"),
        not_null("stg_products", "unit_price"),
        not_null("stg_orders", "order_id"),
        not_null("stg_orders", "quantity"),
        not_null("dim_date", "date_key"),
        unique("dim_date", "date_key"),
        not_null("dim_product", "product_key"),
        unique("dim_product", "product_key"),
        not_null("dim_product", "product_id"),
        not_null("dim_customer", "customer_key"),
        unique("dim_customer", "customer_key"),
        not_null("dim_customer", "customer_id"),
        not_null("fact_sales", "sales_fact_key"),
        unique("fact_sales", "sales_fact_key"),
        not_null("fact_sales", "customer_key"),
        relationship("fact_sales", "customer_key", "dim_customer"),
        not_null("fact_sales", "product_key"),
        relationship("fact_sales", "product_key", "dim_product"),
        not_null("fact_sales", "order_date_key"),
        relationship("fact_sales", "order_date_key", "dim_date", "date_key"),
        not_null("fct_mom_revenue", "year"),
        not_null("fct_mom_revenue", "month"),
        not_null("fct_cohort_retention", "cohort_month"),
        not_null("fct_rfm_segmentation", "rfm_segment"),
    ]


def model_checks() -> list[Check]:
    """The nine assertions run after a sales load."""
    return [
        unique("dim_customer", "customer_key"),
        not_blank("dim_customer", "customer_id"),
        unique("dim_product", "product_key"),
        not_blank("dim_product", "product_id"),
        unique("fact_sales", "sales_fact_key"),
        relationship("fact_sales", "customer_key", "dim_customer", name="foreign_key_customer_exists"),
        relationship("fact_sales", "product_key", "dim_product", name="foreign_key_product_exists"),
        relationship("fact_sales", "order_date_key", "dim_date", "date_key", name="foreign_key_date_exists"),
        in_range("fact_sales", "net_amount", low=0, severity="warning", name="positive_net_amount_constraint"),
    ]


def load_checks() -> list[Check]:
    """Gates after a batch load: surrogate keys present, no orphans, positive quantities."""
    return [
        not_null("dim_customer", "customer_key"),
        not_null("dim_product", "product_key"),
        relationship("fact_sales", "customer_key", "dim_customer", name="orphan_customer"),
        Check("fact_sales", "invalid_quantity", condition=F.col("quantity") <= 0, type="range_check"),
    ]


def staging_checks(temp_low: float = -90.0, temp_high: float = 60.0) -> list[Check]:
    """Gates over the raw domain tables."""
    negative = (F.col("close_price") < 0) | (F.col("open_price") < 0)
    no_ticker = F.col("ticker").isNull() | (F.col("ticker") == "")
    return [
        Check("raw_stock_prices", "null_ticker_check", condition=no_ticker, severity="warning", type="null_check"),
        Check("raw_stock_prices", "negative_price_check", condition=negative, severity="error", type="range_check"),
        in_range("raw_weather_observations", "temp_celsius", temp_low, temp_high, severity="warning", name="temperature_range_check"),
        Check(
            "raw_news_articles", "null_title_check", severity="warning", type="null_check",
            condition=F.col("title").isNull() | (F.trim("title") == ""),
        ),
        Check("raw_stock_prices", "record_count", condition=F.lit(False), severity="info", type="count"),
        Check("raw_weather_observations", "record_count", condition=F.lit(False), severity="info", type="count"),
        Check("raw_news_articles", "record_count", condition=F.lit(False), severity="info", type="count"),
    ]


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row conditions of a table in one pass."""
    counts = [F.count_if(F.coalesce(c.condition, F.lit(False))).alias(f"c{i}") for i, c in enumerate(checks)]
    flat = df.agg(F.count(F.lit(1)).alias("n"), *counts)
    rows = [
        F.struct(
            F.lit(c.table).alias("table_name"), F.lit(c.name).alias("check_name"), F.lit(c.type).alias("check_type"),
            F.lit(c.severity).alias("severity"), F.col("n").alias("records_checked"), F.col(f"c{i}").alias("records_failed"),
        )
        for i, c in enumerate(checks)
    ]
    return flat.select(F.inline(F.array(*rows)))


def _one_row(df: DataFrame, check: Check, failed: Column, checked: Column) -> DataFrame:
    return df.agg(checked.alias("records_checked"), failed.alias("records_failed")).select(
        F.lit(check.table).alias("table_name"), F.lit(check.name).alias("check_name"), F.lit(check.type).alias("check_type"),
        F.lit(check.severity).alias("severity"), "records_checked", "records_failed",
    )


def _unique_check(df: DataFrame, check: Check) -> DataFrame:
    """Number of key values that occur more than once; counted per value, so hot values combine early."""
    groups = df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n"))
    return _one_row(groups, check, F.count_if(F.col("n") > 1), F.coalesce(F.sum("n"), F.lit(0)))


def _reference_check(df: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    """Rows without a parent. Rows are first counted per key value, so only distinct keys meet the parent."""
    column = check.columns[0]
    per_key = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(check.parent_column).alias("_known")).filter("_known is not null").distinct()
    joined = per_key.join(known, F.col(column) == F.col("_known"), "left")
    missing = F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0))
    return _one_row(joined, check, missing, F.coalesce(F.sum("n"), F.lit(0)))


def run_assertions(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: records checked, records failed, severity and status.

    Row conditions of a table share one scan. Status is "pass", else "warn" for
    severity info/warning and "fail" for error/critical.
    """
    results = []
    for table in dict.fromkeys(c.table for c in checks):
        rows = [c for c in checks if c.table == table and c.kind == "rows"]
        if rows:
            results.append(_row_checks(tables[table], rows))
    for check in checks:
        if check.kind == "unique":
            results.append(_unique_check(tables[check.table], check))
        elif check.kind == "reference":
            results.append(_reference_check(tables[check.table], tables[check.parent], check))
    result = reduce(DataFrame.unionByName, results)
    failed = F.col("records_failed") > 0
    status = F.when(~failed, "pass").when(F.col("severity").isin("info", "warning"), "warn").otherwise("fail")
    return result.withColumn("status", status)


def summarize(results: DataFrame) -> DataFrame:
    """checks / passed / warnings / failed."""
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "warn").alias("warnings"),
        F.count_if(F.col("status") == "fail").alias("failed"),
    )


def quality_log(results: DataFrame, run_id: str, checked_at: Column | None = None) -> DataFrame:
    """Log rows for check results; a passed check is logged as info."""
    when = checked_at if checked_at is not None else F.current_timestamp()
    level = F.when(F.col("records_failed") > 0, F.col("severity")).otherwise(F.lit("info"))
    return results.select(
        F.expr("uuid()").alias("id"), F.lit(run_id).alias("pipeline_run_id"), "table_name", "check_name", "check_type",
        F.col("records_checked").cast("bigint").alias("records_checked"),
        F.col("records_failed").cast("bigint").alias("records_failed"),
        level.alias("severity"),
        F.concat(F.col("records_failed").cast("string"), F.lit(" of "), F.col("records_checked").cast("string"), F.lit(" rows failed")).alias("details"),
        when.alias("checked_at"),
    )


def reject_log(rejects: DataFrame, table: str, run_id: str, key_cols: Sequence[str], checked_at: Column | None = None) -> DataFrame:
    """One critical log row per rejected row."""
    when = checked_at if checked_at is not None else F.current_timestamp()
    shown = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))) for c in key_cols]
    return rejects.select(
        F.expr("uuid()").alias("id"), F.lit(run_id).alias("pipeline_run_id"), F.lit(table).alias("table_name"),
        F.lit("Corrupt Value Filter Gate").alias("check_name"), F.lit("Value Range Constraint").alias("check_type"),
        F.lit(1).cast("bigint").alias("records_checked"), F.lit(1).cast("bigint").alias("records_failed"),
        F.lit("critical").alias("severity"),
        F.concat(F.col("reject_reason"), F.lit(": "), F.concat_ws(", ", *shown)).alias("details"),
        when.alias("checked_at"),
    )


def failure_alerts(results: DataFrame, run_id: str) -> DataFrame:
    """Alert rows for error and critical checks that failed on at least one record."""
    bad = results.filter((F.col("records_failed") > 0) & F.col("severity").isin("error", "critical"))
    return bad.select(
        F.lit("critical").alias("alert_type"),
        F.concat(F.lit("Data Quality Check Failed on '"), "table_name", F.lit("'")).alias("title"),
        F.concat(
            F.lit("Check '"), "check_name", F.lit("' failed for "), F.col("records_failed").cast("string"), F.lit(" record(s)."),
        ).alias("message"),
        "table_name", "check_name", "records_failed", F.lit(run_id).alias("pipeline_run_id"),
    )


