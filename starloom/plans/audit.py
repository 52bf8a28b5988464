"""Run header and quality log: append-only, one row per state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import dedupe_latest
from ..operators.profile import one_row, value_counts
from ..operators.ranking import top
from .. import schemas

_RUN_COLUMNS = [p.split()[0] for p in schemas.PIPELINE_RUNS.split(", ")]


def run_started(spark: SparkSession, run_id: str, run_type: str, metadata: dict | None = None) -> DataFrame:
    """The 'running' row of a run; metadata is stored as JSON."""
    encoded = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in (metadata or {}).items()])) if metadata else F.lit("{}")
    return _run_row(spark, run_id, run_type, "running", F.lit(None), {}, None, encoded)


def run_finished(
    spark: SparkSession, run_id: str, run_type: str, status: str, counters: dict[str, int | Column] | None = None, error: str | None = None
) -> DataFrame:
    return _run_row(spark, run_id, run_type, status, F.current_timestamp(), counters or {}, error, F.lit("{}"))


def _run_row(spark, run_id, run_type, status, completed, counters, error, metadata) -> DataFrame:
    def counter(name: str) -> Column:
        value = counters.get(name, 0)
        return (value if isinstance(value, Column) else F.lit(value)).cast("bigint")

    values = {
        "id": F.lit(run_id), "run_type": F.lit(run_type), "status": F.lit(status), "started_at": F.current_timestamp(),
        "completed_at": completed.cast("timestamp"),
        **{c: counter(c) for c in ("records_extracted", "records_loaded", "records_transformed", "records_rejected")},
        "error_message": F.lit(error).cast("string"), "metadata": metadata,
    }
    return one_row(spark, values).select(*_RUN_COLUMNS)


def current_runs(runs: DataFrame) -> DataFrame:
    """The latest state of every run, with the time it first started."""
    started = runs.groupBy("id").agg(F.min("started_at").alias("_first"))
    latest = dedupe_latest(runs, ["id"], ["completed_at", "started_at"])
    return latest.join(started, "id").withColumn("started_at", F.col("_first")).drop("_first").select(*runs.columns)


def run_history(runs: DataFrame, limit: int = 20) -> DataFrame:
    return top(runs, [F.col("started_at").desc(), F.col("id")], limit).drop("metadata")


def quality_history(log: DataFrame, runs: DataFrame, limit: int = 50) -> DataFrame:
    """Newest quality log rows with the type of their run; the limit is taken before the join."""
    newest = top(log, [F.col("checked_at").desc(), F.col("id")], limit)
    types = runs.select(F.col("id").alias("pipeline_run_id"), F.col("run_type").alias("pipeline_run_type"))
    return newest.join(types, "pipeline_run_id", "left").drop("pipeline_run_id")


def status_counts(runs: DataFrame) -> DataFrame:
    return value_counts(runs, "status")


def latest_run(runs: DataFrame) -> DataFrame:
    """The run that started last, as one row; no sort."""
    last = F.max_by(F.struct(*runs.columns), F.struct("started_at", "id"))
    return runs.agg(last.alias("r")).filter("r is not null").select("r.*")


def stream_status(tables: dict[str, DataFrame], log: DataFrame, runs: DataFrame) -> DataFrame:
    """Row counts of the warehouse, quality issues and the latest run on one row."""
    counts = {f"{n}_rows": t.agg(F.count(F.lit(1)).alias("n")).scalar() for n, t in tables.items()}
    last = latest_run(runs).select(F.struct("id", "run_type", "status")).scalar()
    return one_row(
        log.sparkSession,
        {
            **counts,
            "total_quality_check_issues": log.agg(F.count(F.lit(1)).alias("n")).scalar(),
            "latest_run_id": last["id"], "latest_run_type": last["run_type"], "latest_run_status": last["status"],
        },
    )
