"""CSV, JSON-lines and Parquet staging files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import null_tokens_to_null

# Dialect of the staged CSV files.
CSV_NULL_TOKENS = ("NULL", "null", "")
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"
_CORRUPT = "_corrupt_record"


def _fields(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _typed(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return text
    if isinstance(field.dataType, T.TimestampType):
        return F.coalesce(F.try_to_timestamp(text, F.lit(CSV_TIMESTAMP)), text.try_cast("timestamp"))
    return F.trim(text).try_cast(field.dataType)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, bad rows) of headed CSV files with a known schema.

    Quoted fields, several NULL tokens and a fixed timestamp format. A line with the
    wrong number of fields, or a value its type cannot hold, becomes a bad row
    (`line`, `error`) and never fails the load. `pattern` is a file-name glob.
    """
    fields = _fields(schema)
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in fields] + [T.StructField(_CORRUPT, T.StringType())])
    reader = (
        spark.read.schema(raw_schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("columnPruning", False)  # a pruned parse would not notice lines of the wrong length
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    text = reader.csv(path)
    names = [f.name for f in fields]
    text = text.select(*[null_tokens_to_null(n, CSV_NULL_TOKENS).alias(n) for n in names], _CORRUPT)
    lost = [
        F.when(F.col(f.name).isNotNull() & _typed(f).isNull(), F.lit(f"bad {f.name}"))
        for f in fields
        if not isinstance(f.dataType, T.StringType)
    ]
    shape = F.when(F.col(_CORRUPT).isNotNull(), F.lit("wrong number of fields"))
    judged = text.withColumn("_error", F.nullif(F.concat_ws("; ", shape, *lost), F.lit("")))
    good = judged.filter("_error is null").select(*[_typed(f).alias(f.name) for f in fields])
    line = F.coalesce(_CORRUPT, F.concat_ws(",", *[F.coalesce(n, F.lit("")) for n in names]))
    bad = judged.filter("_error is not null").select(line.alias("line"), F.col("_error").alias("error"))
    return good, bad


def read_external_csv(spark: SparkSession, path: str, schema: str | T.StructType, pattern: str | None = None) -> DataFrame:
    """Known columns of headed CSV files, found by header name; unknown columns are ignored, absent ones are NULL."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    text = reader.csv(path)
    have = {c.strip().lower(): c for c in text.columns}
    columns = []
    for f in _fields(schema):
        found = have.get(f.name.lower())
        value = null_tokens_to_null(F.col(f"`{found}`"), CSV_NULL_TOKENS) if found else F.lit(None).cast("string")
        columns.append(value.alias(f.name))
    named = text.select(*columns)
    return named.select(*[_typed(f).alias(f.name) for f in _fields(schema)])


def append_staging(df: DataFrame, path: str) -> None:
    """Add a batch to a staging directory."""
    df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Headed CSV export, one file per partition."""
    (
        df.write.mode("errorifexists").option("header", True).option("quote", '"').option("escape", '"')
        .option("timestampFormat", CSV_TIMESTAMP).csv(path)
    )


def write_clustered(
    df: DataFrame, path: str, date_key: str = "order_date_key", cluster: Sequence[str] = ("customer_key", "product_key"),
    base: int = 20240101, width: int = 100, bucket: str = "date_bucket",
) -> None:
    """Fact write partitioned by a range bucket of the date key and sorted by the cluster columns.

    Rows are rebalanced by bucket: the adaptive plan splits a bucket that holds a large share of
    them over several tasks and packs small buckets together.
    """
    placed = df.withColumn(bucket, F.floor((F.col(date_key) - base) / width).cast("int"))
    (
        placed.hint("rebalance", bucket)
        .sortWithinPartitions(bucket, *cluster)
        .write.mode("errorifexists").partitionBy(bucket).parquet(path)
    )
