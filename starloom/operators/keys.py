"""De-duplication, surrogate keys and neighbours inside a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

_ROWS_PER_PARTITION_BITS = 33  # layout of monotonically_increasing_id()


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    tiebreak: Sequence[str] = (),
    filter_null_keys: bool = False,
) -> DataFrame:
    """One row per key: the newest by `order_cols`, ties settled by `tiebreak` (descending too).

    The ``row_number() == 1`` filter is planned as a group limit on both sides of the
    exchange, so each map task forwards one row per key however hot the key is.
    """
    if filter_null_keys:
        for key in keys:
            df = df.filter(F.col(key).isNotNull())
    order = [F.col(c).desc_nulls_last() for c in [*order_cols, *tiebreak]]
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def max_key(df: DataFrame, key_col: str) -> Column:
    """The largest key so far, 0 for an empty table, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("bigint").alias("m")).scalar()


def _start(start) -> Column:
    return start if isinstance(start, Column) else F.lit(int(start))


def _bucket_count(df: DataFrame) -> int:
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _offsets(counts: DataFrame, slots: int | None) -> Column:
    """Rows before each slot as one array, from (slot, n) counts; without `slots`, up to the last one counted.

    The number of slots follows the number of partitions, never the data.
    """
    sizes = counts.agg(F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("n"), F.max("slot").alias("last"))
    last = F.lit(slots - 1).cast("bigint") if slots is not None else F.coalesce("last", F.lit(0).cast("bigint"))

    def step(state: Column, slot: Column) -> Column:
        size = F.coalesce(F.try_element_at("n", slot), F.lit(0).cast("bigint"))
        return F.named_struct(
            F.lit("total"), state["total"] + size,
            F.lit("before"), F.concat(state["before"], F.array(state["total"])),
        )

    zero = F.named_struct(F.lit("total"), F.lit(0).cast("bigint"), F.lit("before"), F.array().cast("array<bigint>"))
    folded = F.aggregate(F.sequence(F.lit(0).cast("bigint"), last), zero, step)
    return sizes.select(folded["before"].alias("offsets")).scalar()


def dense_key(
    df: DataFrame, key_col: str, natural: Sequence[str], start=0, buckets: int | None = None, written: bool = False
) -> DataFrame:
    """Gap-free keys ``start+1 .. start+n`` without funnelling rows through one task.

    Rows are spread over hash buckets of their natural key, numbered inside the
    bucket, and shifted by the row count of the buckets before it. The result is a
    function of the data alone, so a recomputed partition gets the same keys.

    The input is evaluated twice, for the counts and for the rows; with `written` it is evaluated once and
    written with its places, and the counts are those of the written buckets.
    """
    n = buckets or _bucket_count(df)
    bucketed = df.withColumn("_slot", F.pmod(F.xxhash64(*natural), F.lit(n).cast("bigint")))
    if written:
        place = F.row_number().over(W.partitionBy("_slot").orderBy(*natural))
        placed = materialize(bucketed.withColumn("_place", place), "keyed")
        counts = placed.groupBy(F.col("_slot").alias("slot")).agg(F.max("_place").cast("bigint").alias("n"))
        key = _start(start) + F.element_at(_offsets(counts, n), (F.col("_slot") + 1).cast("int")) + F.col("_place")
        return placed.withColumn(key_col, key.cast("bigint")).drop("_slot", "_place")
    counts = bucketed.groupBy(F.col("_slot").alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    offsets = _offsets(counts, n)
    number = F.row_number().over(W.partitionBy("_slot").orderBy(*natural))
    key = _start(start) + F.element_at(offsets, (F.col("_slot") + 1).cast("int")) + number
    return bucketed.withColumn(key_col, key.cast("bigint")).drop("_slot")


def sequence_key(df: DataFrame, key_col: str, start=0) -> DataFrame:
    """Unique, increasing keys with gaps, as a database sequence gives; needs no shuffle.

    The numbers depend on the physical partitions: assign them in the plan that writes the table.
    """
    key = _start(start) + F.monotonically_increasing_id() + 1
    return df.withColumn(key_col, key.cast("bigint"))


def ordered_key(df: DataFrame, key_col: str, order_by: Sequence[str], start=0) -> DataFrame:
    """``start + row_number() over (order by ...)`` for a total order, computed range-parallel.

    A range exchange and a local sort give every row its place inside its partition;
    the written table keeps partition and place, and the partition sizes give the shift.
    """
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = materialize(placed, "ordered")
    part = F.shiftright("_place", _ROWS_PER_PARTITION_BITS)
    counts = placed.groupBy(part.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    offsets = _offsets(counts, None)
    place = F.col("_place").bitwiseAND(F.lit((1 << _ROWS_PER_PARTITION_BITS) - 1))
    key = _start(start) + F.element_at(offsets, (part + 1).cast("int")) + place + 1
    return placed.withColumn(key_col, key.cast("bigint")).drop("_place")


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    out: str,
    ahead: bool = False,
    bucket: Column | None = None,
) -> DataFrame:
    """Add `out`, a struct of the previous (or next) row's `columns` inside a key.

    Without `bucket` this is a plain LAG / LEAD. With `bucket`, an expression that
    never decreases along `order` (a day, say), the window runs inside (key, bucket)
    and only the edge row of each bucket crosses over, so one hot key is split
    into as many tasks as it has buckets.
    """
    payload = F.struct(*columns)
    step = F.lead if ahead else F.lag
    if bucket is None:
        return df.withColumn(out, step(payload).over(W.partitionBy(*keys).orderBy(*order)))

    cells = df.withColumn("_bucket", bucket)
    inner = W.partitionBy(*keys, "_bucket").orderBy(*order)
    edge = (F.min_by if ahead else F.max_by)(payload, F.struct(*order))
    edges = cells.groupBy(*keys, "_bucket").agg(edge.alias("_edge"))
    across = W.partitionBy(*keys).orderBy("_bucket")
    edges = edges.withColumn("_carry", step("_edge").over(across)).drop("_edge")
    on = [F.col(f"c.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys]
    on.append(F.col("c._bucket").eqNullSafe(F.col("e._bucket")))
    stepped = cells.withColumn("_inner", step(payload).over(inner))
    return stepped.alias("c").join(edges.alias("e"), on, "left").select(
        *[F.col(f"c.{c}") for c in df.columns],
        F.coalesce("c._inner", "e._carry").alias(out),
    )


def changed(columns: Sequence[str], other: str) -> Column:
    """True where any of the columns differs, NULLs included, from the struct column `other`."""
    test = F.lit(False)
    for c in columns:
        test = test | ~F.col(c).eqNullSafe(F.col(f"{other}.{c}"))
    return test


