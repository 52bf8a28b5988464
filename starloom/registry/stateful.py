"""Streams with keyed state: late and repeated records end where a batch over all of them would."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import bindings as B
from ..session import scratch_path
from ..streaming import state
from . import sql as S
from .core import ORACLE, query
from .loads import EVENT_VERSIONS

#: Files of a delivery, and of a micro-batch.
FILES = 2


def _arrive(df: DataFrame, period, late, folder: str) -> None:
    """Drop rows as one delivery a period, in order: rows of `late` a period after their own, and every tenth row twice.

    A delivery is at most FILES files however large it is, so the number of micro-batches follows the periods and not the rows.
    """
    own = period + F.when(late, 1).otherwise(0)
    again = F.when(F.xxhash64(*df.columns) % 10 == 0, F.array(own, own + 1)).otherwise(F.array(own))
    deliveries = df.withColumn("_delivery", F.explode(again)).persist()
    low, high = deliveries.agg(F.min("_delivery"), F.max("_delivery")).first()
    for n in range(low, high + 1):
        deliveries.filter(F.col("_delivery") == n).drop("_delivery").coalesce(FILES).write.mode("append").parquet(folder)
    deliveries.unpersist()


@query("stream_state_versions", ORACLE["scd2_event_log"])
def stream_state_versions(spark, sf_dir) -> DataFrame:
    """Versions kept as keyed state of a stream of five-day deliveries with late and repeated changes, as from the whole log."""
    root = scratch_path(spark, "state-versions")
    log = B.table(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    period = F.floor(F.unix_seconds("ts") / (5 * 86_400)).cast("int")
    _arrive(log, period, F.col("event_id") % 7 == 0, f"{root}/drop")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", FILES).parquet(f"{root}/drop")
    # a row comes at most two deliveries after its own
    changes = state.version_changes(stream, ["event_type"], "ts", EVENT_VERSIONS, "event_id", "15 days")
    state.apply_changes(changes, f"{root}/changes", f"{root}/checkpoint").awaitTermination()
    return state.versions_from(spark, f"{root}/changes", changes.schema, log.select("event_type").schema, EVENT_VERSIONS)


@query("stream_state_lines", f"""
SELECT {S.big('year(l_shipdate)')} AS ship_year, COUNT(DISTINCT (l_orderkey, l_linenumber, l_shipdate)) AS lines FROM lineitem GROUP BY 1""")
def stream_state_lines(spark, sf_dir) -> DataFrame:
    """Order lines of two-year deliveries, some late and some repeated, counted once each; here a number is used again on other days."""
    root = scratch_path(spark, "state-lines")
    lines = B.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("shipped"))
    _arrive(lines, F.floor(F.year("shipped") / 2).cast("int"), F.col("l_orderkey") % 7 == 0, f"{root}/drop")
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", FILES).parquet(f"{root}/drop")
    once = state.unique_lines(stream, ["l_orderkey", "l_linenumber", "shipped"], "shipped", "2200 days")
    writer = once.writeStream.format("parquet").option("path", f"{root}/lines").option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    kept = spark.read.schema(lines.schema).parquet(f"{root}/lines")
    return kept.groupBy(F.year("shipped").cast("bigint").alias("ship_year")).agg(F.count(F.lit(1)).alias("lines"))
