"""Registration and result normalisation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Result types every engine prints alike: text dates, DOUBLE decimals, BIGINT integers."""
    out = []
    for f in df.schema:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("bigint")
        out.append(col.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; the returned frame is made portable."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(spark, sf_dir))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register
