"""File-drop streams into the warehouse."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import (
    CUSTOMER_COLUMNS, FINANCE_COLUMNS, FITNESS_COLUMNS, MEDIA_COLUMNS, NEWS_ALIASES, NEWS_KEYS, NEWS_MARKS, ORDER_COLUMNS, PRODUCT_COLUMNS, STOCK_ALIASES, STOCK_KEYS,
    STOCK_MARKS, WEATHER_ALIASES, WEATHER_MARKS,
)
from ..sources.store import TableStore
from .batch import SOURCE_FILE, SOURCE_TIME, process_batch


def wide_schema() -> T.StructType:
    """Every column any domain understands, as text; nothing is inferred from files."""
    names: dict[str, None] = {}
    for group in (CUSTOMER_COLUMNS, PRODUCT_COLUMNS, ORDER_COLUMNS, STOCK_KEYS, STOCK_MARKS, NEWS_KEYS, NEWS_MARKS, WEATHER_MARKS, FINANCE_COLUMNS, FITNESS_COLUMNS, MEDIA_COLUMNS):
        names.update(dict.fromkeys(group))
    for aliases in (WEATHER_ALIASES, STOCK_ALIASES, NEWS_ALIASES):
        for spellings in aliases.values():
            names.update(dict.fromkeys(spellings))
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def ingest_files(
    spark: SparkSession,
    folder: str,
    file_format: str,
    store: TableStore,
    checkpoint: str,
    schema: T.StructType | None = None,
    archive: str | None = None,
    files_per_batch: int = 100,
    poll_seconds: float | None = None,
    stream: str = "files",
    **batch_options,
) -> StreamingQuery:
    """Feed dropped CSV, JSON-lines or Parquet files to `process_batch`, each file once, oldest first.

    Tables don't depend on `files_per_batch`: a batch applies its files one by one and commits once.

    With `poll_seconds` the folder is watched, otherwise what is there is processed and the query
    stops. `archive` moves finished files away. CSV files need the schema of their header;
    JSON and Parquet are matched by name.
    """
    reader = spark.readStream.format(file_format).schema(schema or wide_schema()).option("maxFilesPerTrigger", files_per_batch)
    if file_format == "csv":
        reader = reader.option("header", True).option("quote", '"').option("escape", '"')
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    writer = (
        reader.load(folder)
        .select("*", F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_modification_time").alias(SOURCE_TIME))
        .writeStream.queryName(stream)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: process_batch(batch, batch_id, store, stream, **batch_options) and None)
    )
    if poll_seconds is not None:
        return writer.trigger(processingTime=f"{int(poll_seconds * 1000)} milliseconds").start()
    return writer.trigger(availableNow=True).start()
