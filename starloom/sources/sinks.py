"""Whole-table operations over the store: preview, replication, purge, layers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import table_counts
from ..operators.ranking import top
from .store import TableStore

# Tables that may be previewed, the row cap, and the replication order.
PREVIEW_TABLES = (
    "raw_stock_prices", "raw_weather_observations", "raw_news_articles", "dim_date", "dim_company", "dim_location",
    "dim_news_source", "fact_stock_prices", "fact_weather_readings", "fact_news_articles", "pipeline_runs", "data_quality_log",
)
PREVIEW_CAP = 500
REPLICATED_TABLES = (
    "fact_sales", "fact_stock_prices", "fact_weather_readings", "fact_news_articles",
    "stg_customers", "stg_products", "stg_orders",
    "dim_date", "dim_customer", "dim_product", "dim_company", "dim_location", "dim_news_source",
    "raw_stock_prices", "raw_weather_observations", "raw_news_articles",
    "pipeline_runs", "data_quality_log",
)
PURGE_ORDER = {
    "weather": ("fact_weather_readings", "raw_weather_observations"),
    "stocks": ("fact_stock_prices", "raw_stock_prices", "dim_company"),
    "news": ("fact_news_articles", "raw_news_articles", "dim_news_source"),
    "sales": ("fact_sales", "stg_orders", "stg_products", "stg_customers", "dim_product", "dim_customer"),
}
PURGE_ORDER["all"] = (
    "fact_sales", "fact_stock_prices", "fact_weather_readings", "fact_news_articles", "stg_orders", "stg_products",
    "stg_customers", "raw_stock_prices", "raw_weather_observations", "raw_news_articles", "dim_product", "dim_customer",
    "dim_company", "dim_location", "dim_news_source", "data_quality_log", "pipeline_runs",
)


def preview(
    tables: dict[str, DataFrame], name: str, limit: int = 50, allowed: Sequence[str] = PREVIEW_TABLES, order_by: Sequence[str] = ()
) -> DataFrame:
    """At most `limit` rows (never more than the cap) of an allow-listed table."""
    if name not in allowed:
        raise ValueError(f"table {name!r} may not be previewed; allowed: {sorted(allowed)}")
    rows = min(limit, PREVIEW_CAP)
    if order_by:
        return top(tables[name], [F.col(c) for c in order_by], rows)
    return tables[name].limit(rows)


def _copy(source: TableStore, target: TableStore, name: str, entry: dict, segments: list[dict]) -> list[dict]:
    """Write segments of the source below the target in one job, each as a segment of its own that names its origin."""
    if not segments:
        return []
    folder = f"seg={uuid.uuid4().hex}"
    numbers = source.spark.createDataFrame([(s["path"], k) for k, s in enumerate(segments)], "_origin string, seg_part int")
    rows = source.segments(name, entry, segments)
    origin = F.regexp_extract(F.col("_metadata.file_path"), r"(seg=[^/]+(?:/seg_part=[^/]+)?)/[^/]+$", 1)
    numbered = rows.select("*", origin.alias("_origin")).join(F.broadcast(numbers), "_origin").drop("_origin")  # a row per segment
    numbered.hint("rebalance", "seg_part").write.mode("errorifexists").partitionBy("seg_part").parquet(f"{target.root}/{name}/{folder}")
    return [{**s, "path": f"{folder}/seg_part={k}", "origin": s["path"], "filter": None, "slices": 0} for k, s in enumerate(segments)]


def refresh_replica(source: TableStore, target: TableStore, names: Sequence[str] = REPLICATED_TABLES) -> dict[str, dict[str, int]]:
    """Bring another store to the source's state in one commit, by the difference of the two manifests.

    Segments never change, so those the target has copied before stay; new ones are copied, those the source has dropped
    are dropped. Returns copied_segments, copied_rows and dropped_segments of each table; nothing new, no commit.
    """
    now, txn, out = source.manifest(), target.begin(), {}
    for name in [n for n in names if n in now["tables"]]:
        entry = now["tables"][name]
        mine = txn.tables.get(name)
        had = {s.get("origin"): s for s in mine["segments"]} if mine is not None else {}
        missing = [s for s in entry["segments"] if s["path"] not in had]
        gone = set(had) - {s["path"] for s in entry["segments"]}
        if mine is None or missing or gone or any(mine[k] != entry[k] for k in ("schema", "high")):
            copied = {s["origin"]: s for s in _copy(source, target, name, entry, missing)}
            txn.adopt(name, entry, [copied.get(s["path"]) or had[s["path"]] for s in entry["segments"]])
        out[name] = {"copied_segments": len(missing), "copied_rows": sum(s["rows"] for s in missing), "dropped_segments": len(gone)}
    if txn.tables != txn.base["tables"]:
        txn.commit()
    return out


def replicate(source: TableStore, target: TableStore | None, names: Sequence[str] = REPLICATED_TABLES) -> DataFrame:
    """Bring tables of another store up to date in one commit and return (table_name, source_rows, target_rows).

    Only segments the target lacks are copied. Without a target this is a dry run that only counts. Missing tables are
    skipped, and an emptied table empties the target's copy. Counts come from the written files, not from the copy job.
    """
    tables = {n: source.read(n) for n in names}
    present = {n: t for n, t in tables.items() if t is not None}
    counted = table_counts(present).withColumnRenamed("row_count", "source_rows")
    if target is None:
        return counted.withColumn("target_rows", F.lit(None).cast("bigint"))
    refresh_replica(source, target, names)
    copied = table_counts({n: target.read(n) for n in present})
    return counted.join(copied.withColumnRenamed("row_count", "target_rows"), "table_name")


def purge(store: TableStore, domain: str) -> DataFrame:
    """Empty a domain's tables, facts before dimensions, in one commit; returns the deleted row counts."""
    names = [n for n in PURGE_ORDER[domain] if n in store.names()]
    counts = table_counts({n: store.read(n) for n in names}).withColumnRenamed("row_count", "deleted_rows")
    txn = store.begin()
    for name in names:
        txn.clear(name)
    txn.commit()
    return counts  # reads the segments it counted, which stay on disk until vacuumed


def publish_layer(spark: SparkSession, frames: dict[str, DataFrame], materialized: str, store: TableStore | None = None) -> dict[str, DataFrame]:
    """Publish a model layer as views (lazy) or as tables (written once, read by everyone after)."""
    if materialized == "view":
        for name, frame in frames.items():
            frame.createOrReplaceTempView(name)
        return dict(frames)
    if materialized != "table":
        raise ValueError(f"materialized must be 'view' or 'table', not {materialized!r}")
    txn = store.begin()
    published = {name: txn.replace(name, frame) for name, frame in frames.items()}
    txn.commit()
    for name, frame in published.items():
        frame.createOrReplaceTempView(name)
    return published
