"""Upserts and slowly changing dimensions, as 'old state + batch -> new state'."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .joins import CUSTOMER_VERSIONS, Versioned, not_loaded
from .keys import changed, dense_key, max_key, neighbour


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols.

    `source` has one row per key. ``update_cols=None`` overwrites every non-key column,
    ``[]`` is DO NOTHING. Keys compare null-safe; a source without a column of the target keeps it.
    """
    if update_cols is None:
        update_cols = [c for c in target.columns if c not in keys and c in source.columns]
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    old = target.withColumn("_old", F.lit(True)).alias("t")
    new = source.withColumn("_new", F.lit(True)).alias("s")
    in_old, in_new = F.col("t._old").isNotNull(), F.col("s._new").isNotNull()
    picked = []
    for name in target.columns:
        if name not in source.columns:
            value = F.col(f"t.{name}")
        elif name in update_cols:
            value = F.when(in_new, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))
        else:
            value = F.when(in_old, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))
        picked.append(value.cast(target.schema[name].dataType).alias(name))
    return old.join(new, on, "full").select(*picked)


def insert_new(
    target: DataFrame, source: DataFrame, keys: Sequence[str], surrogate: str, known: DataFrame | None = None, start: int | None = None
) -> DataFrame:
    """Rows of `source` (one per natural key) that the dimension lacks, with keys after its maximum.

    `known` are the rows of the dimension that count as present (all by default); keys follow the maximum over all rows,
    or `start`, the largest key given so far, where `target` is only a part of the dimension.
    """
    fresh = not_loaded(source, target if known is None else known, keys)
    keyed = dense_key(fresh, surrogate, keys, max_key(target, surrogate) if start is None else start)
    return keyed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema])


def scd1_merge(
    dim: DataFrame,
    staged: DataFrame,
    key: str,
    attrs: Sequence[str],
    surrogate: str,
    compare_cols: Sequence[str] | None = None,
    extra: dict[str, Column] | None = None,
    ts: str | None = None,
    start: int | None = None,
) -> DataFrame:
    """Overwrite changed members, insert new ones.

    A member is rewritten as a whole when any of `compare_cols` (default: all of `attrs` but
    the update time) differs; with `ts`, only by a record that is not older than the member.
    `extra` gives constants for columns that only new members set. `start` is the largest key given so far
    where `dim` is only a part of the dimension.
    """
    compare = list(compare_cols or [a for a in attrs if a != ts])
    side = staged.select(F.col(key).alias("_id"), F.struct(*attrs).alias("_s"))
    differs = F.col("_s").isNotNull() & changed(compare, "_s")
    if ts is not None:
        differs = differs & F.coalesce(F.col(f"_s.{ts}") >= F.col(ts), F.lit(True))
    kept = dim.join(side, F.col(key) == F.col("_id"), "left").select(
        *[F.when(differs, F.col(f"_s.{c}")).otherwise(F.col(c)).alias(c) if c in attrs else F.col(c) for c in dim.columns]
    )
    fresh = dense_key(not_loaded(staged, dim, [key]), surrogate, [key], max_key(dim, surrogate) if start is None else start)
    for name, value in (extra or {}).items():
        fresh = fresh.withColumn(name, value)
    return kept.unionByName(_like(fresh, dim))


def _like(df: DataFrame, model: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in model.schema])


def scd2_changes(
    dim: DataFrame, staged: DataFrame, tracked: Sequence[str], ts: str, spec: Versioned = CUSTOMER_VERSIONS
) -> DataFrame:
    """What a batch (one row per id) does to the current versions.

    One full outer join of current versions and batch; each id yields its untouched row
    ("keep"), or its closed row ("expire") and its successor ("insert"), or a first version
    ("insert"). Only `tracked` columns are compared; a new version takes every column the batch has, and the
    others from the version before. A staged row older than the current version is stale and changes nothing.
    """
    current = dim.filter(F.col(spec.current))
    old = current.select(F.col(spec.key).alias("_id"), F.struct(*dim.columns).alias("_o"))
    own = {spec.key, spec.surrogate, spec.start, spec.end, spec.current}
    given = list(dict.fromkeys([*tracked, *[c for c in dim.columns if c in staged.columns and c not in own]]))
    new = staged.select(F.col(spec.key).alias("_sid"), F.col(ts).alias("_ts"), F.struct(*given).alias("_n"))
    joined = old.join(new, F.col("_id") == F.col("_sid"), "full")

    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}"))
    known, staged_row = F.col("_o").isNotNull(), F.col("_n").isNotNull()
    replaced = known & staged_row & differs & (F.col("_ts") >= F.col(f"_o.{spec.start}"))

    types = {f.name: f.dataType for f in dim.schema}

    def row(action: str, **values: Column) -> Column:
        cols = [values.get(c, F.col(f"_o.{c}")).cast(types[c]).alias(c) for c in dim.columns]
        return F.struct(F.lit(action).alias("action"), *cols)

    kept = row("keep")
    expired = row("expire", **{spec.end: F.col("_ts"), spec.current: F.lit(False)})
    fresh_values = {c: F.col(f"_n.{c}") for c in given}
    fresh_values |= {
        spec.key: F.col("_sid"),
        spec.surrogate: F.lit(None),
        spec.start: F.col("_ts"),
        spec.end: F.lit(None),
        spec.current: F.lit(True),
    }
    fresh = row("insert", **fresh_values)
    rows = F.when(replaced, F.array(expired, fresh)).when(known, F.array(kept)).otherwise(F.array(fresh))
    return joined.select(F.explode(rows).alias("_r")).select("_r.*")


def scd2_merge(
    dim: DataFrame, staged: DataFrame, tracked: Sequence[str], ts: str, spec: Versioned = CUSTOMER_VERSIONS, start: int | None = None
) -> DataFrame:
    """The dimension after a batch: history untouched, changed versions closed, new versions open.

    Closed and new versions, which are few beside the dimension, are written once; the
    dimension itself is then passed through an anti join with the closed keys. New versions get keys
    after the largest one so far: `start`, where `dim` is only a part of the dimension.
    """
    changes = scd2_changes(dim, staged, tracked, ts, spec)
    delta = materialize(changes.filter("action <> 'keep'"), "scd2-delta")
    closed = delta.filter("action = 'expire'").drop("action")
    inserted = dense_key(
        delta.filter("action = 'insert'").drop("action", spec.surrogate),
        spec.surrogate, [spec.key, spec.start], max_key(dim, spec.surrogate) if start is None else start,
    )
    untouched = dim.join(closed.select(spec.surrogate), spec.surrogate, "left_anti").select(*dim.columns)
    return untouched.unionByName(closed).unionByName(_like(inserted, dim))


def change_points(
    log: DataFrame, key: str, tracked: Sequence[str], ts: str, order: Sequence[str] = (), bucket: str | None = "day"
) -> DataFrame:
    """Rows of a change log whose tracked columns differ from the row before them."""
    cell = F.date_trunc(bucket, ts) if bucket else None
    stepped = neighbour(log, [key], [ts, *order], list(tracked), "_prev", bucket=cell)
    return stepped.filter(F.col("_prev").isNull() | changed(tracked, "_prev")).drop("_prev")


def scd2_from_log(
    log: DataFrame,
    tracked: Sequence[str],
    ts: str,
    spec: Versioned,
    order: Sequence[str] = (),
    dim: DataFrame | None = None,
    bucket: str | None = "day",
) -> DataFrame:
    """All versions a log of changes describes, several per id and batch included.

    With `dim`, its current versions are the starting points: they keep their keys and
    are closed by the first change after them; log rows older than them are stale.
    """
    order = list(order)
    rows = log.select(spec.key, F.col(ts).alias(spec.start), *tracked, *order)
    if dim is not None:
        rows = rows.withColumn(spec.surrogate, F.lit(None).cast("bigint"))
        current = dim.filter(F.col(spec.current))
        begin = current.select(F.col(spec.key).alias("_id"), F.col(spec.start).alias("_begin"))
        rows = rows.join(begin, F.col(spec.key) == F.col("_id"), "left").filter(
            F.col("_begin").isNull() | (F.col(spec.start) >= F.col("_begin"))
        ).drop("_id", "_begin")
        rows = rows.withColumn("_first", F.lit(1))
        opened = current.select(
            spec.key, spec.start, *tracked, spec.surrogate, *[F.lit(None).cast(log.schema[o].dataType).alias(o) for o in order]
        ).withColumn("_first", F.lit(0))
        rows = rows.unionByName(opened)
        order = ["_first", *order]
    points = change_points(rows, spec.key, tracked, spec.start, order, bucket)
    cell = F.date_trunc(bucket, spec.start) if bucket else None
    stepped = neighbour(points, [spec.key], [spec.start, *order], [spec.start], "_next", ahead=True, bucket=cell)
    versions = stepped.select(
        spec.key, *tracked, spec.start,
        F.col(f"_next.{spec.start}").alias(spec.end),
        F.col("_next").isNull().alias(spec.current),
        *([spec.surrogate] if dim is not None else []),
    )
    if dim is None:
        return dense_key(versions, spec.surrogate, [spec.key, spec.start], written=True)  # the windows run once
    kept = versions.filter(F.col(spec.surrogate).isNotNull())
    fresh = dense_key(
        versions.filter(F.col(spec.surrogate).isNull()).drop(spec.surrogate),
        spec.surrogate, [spec.key, spec.start], max_key(dim, spec.surrogate),
    )
    history = dim.filter(~F.col(spec.current)).select(*kept.columns)
    return history.unionByName(kept).unionByName(fresh)


def version_history(dim: DataFrame, spec: Versioned = CUSTOMER_VERSIONS) -> DataFrame:
    """Every version of the ids that have more than one."""
    several = dim.groupBy(spec.key).count().filter("count > 1")
    return dim.join(several.select(spec.key), spec.key, "left_semi")


def overlaps(dim: DataFrame, spec: Versioned = CUSTOMER_VERSIONS, bucket: str | None = "day") -> DataFrame:
    """Versions that break the interval rule: end differs from the next start, or an open end is not last."""
    cell = F.date_trunc(bucket, spec.start) if bucket else None
    stepped = neighbour(dim, [spec.key], [spec.start, spec.surrogate], [spec.start], "_next", ahead=True, bucket=cell)
    next_start = F.col(f"_next.{spec.start}")
    last = F.col("_next").isNull()
    broken = (~last & ~F.col(spec.end).eqNullSafe(next_start)) | (last != F.col(spec.current))
    return stepped.filter(broken).select(*dim.columns, next_start.alias("next_start"))
