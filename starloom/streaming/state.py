"""Streams whose operators keep state by key: lines seen before, and versions built from late and repeated changes.

Both stay exact for records that arrive within the allowed delay of the newest event time seen, in any order and any number of times.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import Versioned

_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
VERSION, GONE, LATE = "version", "gone", "late"


def unique_lines(lines: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first arrival of every key; repeats within `delay` of each other are dropped, and so are lines older than the watermark.

    The state holds a key until the watermark has passed its event time by `delay`, so it follows the rate of the stream and not its age.
    """
    return lines.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def _runs(held: dict) -> dict[tuple[int, int], tuple[int | None, str]]:
    """(start, order) -> (end, payload) of the versions the held changes describe; the last one is open."""
    points = [tuple(held["base"])] if held["base"] else []
    for at, order, payload in sorted(held["rows"]):
        if not points or points[-1][2] != payload:
            points.append((at, order, payload))
    ends = [p[0] for p in points[1:]]
    return {(at, order): (end, payload) for (at, order, payload), end in zip(points, [*ends, None])}


def fold_changes(held: dict, arrived: Sequence[tuple[int, int, str]], horizon: int | None) -> list[tuple]:
    """Take changes into one id's state; the rows (action, start, order, end, payload) its versions changed by.

    `held` is {"base": the open version before the horizon or None, "rows": changes at or after it} and is updated. Changes older than `horizon`
    can't move versions any more and are returned as late; of two with the same time and order the one with the larger payload counts.
    """
    before = _runs(held)
    known = {(at, order): payload for at, order, payload in held["rows"]}
    out = []
    for at, order, payload in arrived:
        if horizon is not None and at < horizon:
            out.append((LATE, at, order, None, payload))
        else:
            known[at, order] = max(payload, known.get((at, order), payload))
    held["rows"] = [(at, order, payload) for (at, order), payload in sorted(known.items())]
    after = _runs(held)
    out += [(GONE, at, order, None, None) for at, order in before if (at, order) not in after]
    out += [(VERSION, *point, *version) for point, version in after.items() if before.get(point) != version]
    if horizon is not None:
        settled = {"base": held["base"], "rows": [r for r in held["rows"] if r[0] < horizon]}
        if settled["rows"]:
            (at, order), (_, payload) = list(_runs(settled).items())[-1]
            held["base"], held["rows"] = (at, order, payload), [r for r in held["rows"] if r[0] >= horizon]
    return out


def version_changes(log: DataFrame, tracked: Sequence[str], ts: str, spec: Versioned, order: str, delay: str) -> DataFrame:
    """What a stream of changes does to the versions of its ids, as rows for `apply_changes`.

    The state of an id is its open version and the changes of the last `delay`, which a late one may still part; everything older is one row.
    Rows without id or time are left out, a null `order` (a whole number that tells changes of one instant apart) counts as 0, and null
    attributes are values like any other. A version's row is sent again when a late change moves its end, as `gone` when it is no version
    any more; changes older than the watermark come out as `late`, none is lost silently.
    """
    key = log.schema[spec.key]
    known = (
        log.filter(F.col(spec.key).isNotNull() & F.col(ts).isNotNull())
        .withColumn("_time", F.col(ts).cast("timestamp"))
        .withWatermark("_time", delay)
        .select(
            spec.key, "_time", F.unix_micros("_time").alias("_at"), F.coalesce(F.col(order).cast("bigint"), F.lit(0)).alias("_order"),
            F.to_json(F.struct(*tracked), _JSON).alias("_payload"),
        )
    )

    def step(ident: tuple, frames: Iterator, state) -> Iterator:
        import pandas as pd

        held = json.loads(state.get[0]) if state.exists else {"base": None, "rows": []}
        held["rows"] = [tuple(r) for r in held["rows"]]
        mark = state.getCurrentWatermarkMs()
        arrived = [row for f in frames for row in zip(f["_at"].tolist(), f["_order"].tolist(), f["_payload"].tolist())]
        moved = fold_changes(held, arrived, mark * 1000 if mark > 0 else None)
        state.update((json.dumps(held),))
        made = pd.DataFrame(moved, columns=["action", "_at", "_order", "_until", "_payload"], dtype=object)
        made.insert(0, spec.key, ident[0])
        yield made

    out = T.StructType([
        T.StructField(spec.key, key.dataType), T.StructField("action", T.StringType()), T.StructField("_at", T.LongType()),
        T.StructField("_order", T.LongType()), T.StructField("_until", T.LongType()), T.StructField("_payload", T.StringType()),
    ])
    return known.groupBy(spec.key).applyInPandasWithState(step, out, "held string", "update", "NoTimeout")


def apply_changes(changes: DataFrame, folder: str, checkpoint: str, poll_seconds: float | None = None) -> StreamingQuery:
    """Write the rows of `version_changes`, one folder a micro-batch; a batch run again replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    writer = changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    if poll_seconds is not None:
        return writer.trigger(processingTime=f"{int(poll_seconds * 1000)} milliseconds").start()
    return writer.trigger(availableNow=True).start()


def _written(spark: SparkSession, folder: str, changes: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*changes.fields, T.StructField("batch", T.LongType())])).parquet(folder)


def versions_from(spark: SparkSession, folder: str, changes: T.StructType, tracked: T.StructType, spec: Versioned) -> DataFrame:
    """The versions after all batches written: of every (id, start) the row of the newest batch, unless it says `gone`.

    `changes` is the schema of the streamed rows, `tracked` that of the attributes.
    """
    newest = (
        _written(spark, folder, changes).filter(F.col("action") != LATE)
        .groupBy(spec.key, "_at", "_order")
        .agg(F.max_by(F.struct("action", "_until", "_payload"), "batch").alias("_last"))
        .filter(F.col("_last.action") == VERSION)
        .withColumn("_attributes", F.from_json("_last._payload", tracked, _JSON))
    )
    return newest.select(
        spec.key, *[F.col(f"_attributes.{n}").alias(n) for n in tracked.names], F.timestamp_micros("_at").alias(spec.start),
        F.timestamp_micros("_last._until").alias(spec.end), F.col("_last._until").isNull().alias(spec.current),
    )


def late_changes(spark: SparkSession, folder: str, changes: T.StructType, spec: Versioned) -> DataFrame:
    """The changes that came after the watermark had passed them."""
    late = _written(spark, folder, changes).filter(F.col("action") == LATE)
    return late.select(spec.key, F.timestamp_micros("_at").alias("changed_at"), F.col("_payload").alias("payload"), "batch")
