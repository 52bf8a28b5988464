"""Counts and profiles of whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """(table_name, row_count) per table in one job; -1 for a table that is missing."""
    present = {n: t for n, t in tables.items() if t is not None}
    if not present:
        raise ValueError("no table to count")
    counted = [
        t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, t in present.items()
    ]
    result = reduce(DataFrame.unionByName, counted)
    missing = [n for n, t in tables.items() if t is None]
    if missing:
        spark = result.sparkSession
        gaps = spark.createDataFrame([(n, -1) for n in missing], "table_name string, row_count long")
        result = result.unionByName(gaps)
    return result


def one_row(spark, values: dict[str, Column]) -> DataFrame:
    """A panel of scalars (literals or scalar subqueries) as one row."""
    return spark.range(1).select(*[v.alias(n) for n, v in values.items()])


def batch_profile(df: DataFrame) -> DataFrame:
    """Rows, columns and missing cells of a batch, in one pass."""
    missing = reduce(lambda a, b: a + b, [F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        missing.alias("missing_values"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def resum(df: DataFrame, keys: Sequence[str], measure: str, out: str) -> DataFrame:
    """Roll a mart up to fewer keys."""
    return df.groupBy(*keys).agg(F.sum(measure).alias(out))


def sum_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))
