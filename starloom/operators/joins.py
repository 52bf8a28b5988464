"""Star joins, incremental anti joins and joins against versioned dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import fits_broadcast, materialize

_FOREVER = "9999-12-31 00:00:00"
MANY_VERSIONS = 64  # above this, testing every version of an id per fact row is too slow


@dataclass(frozen=True)
class Versioned:
    """Column names of a versioned (type 2) dimension."""

    key: str = "customer_id"
    surrogate: str = "customer_key"
    start: str = "effective_start_date"
    end: str = "effective_end_date"
    current: str = "is_current"


CUSTOMER_VERSIONS = Versioned()


def star_join(fact: DataFrame, *dims: tuple[DataFrame, str | Sequence[str]], how: str = "inner") -> DataFrame:
    """Join dimensions on their surrogate keys.

    No hint: the session's broadcast threshold, and at run time the adaptive plan,
    decides by size between a broadcast and a skew-splitting shuffle join.
    """
    for dim, key in dims:
        fact = fact.join(dim, [key] if isinstance(key, str) else list(key), how)
    return fact


def current_only(dim: DataFrame, flag: str = "is_current") -> DataFrame:
    return dim.filter(F.col(flag))


def not_loaded(
    incoming: DataFrame, loaded: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Incoming rows whose key is not in the loaded table (NOT EXISTS)."""
    if not null_safe:
        return incoming.join(loaded.select(*keys), list(keys), "left_anti")
    on = [F.col(f"i.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys]
    return incoming.alias("i").join(loaded.select(*keys).alias("l"), on, "left_anti")


def not_loaded_since(
    incoming: DataFrame, loaded: DataFrame, keys: Sequence[str], partition: str
) -> DataFrame:
    """`not_loaded` that reads only the fact partitions the batch can touch.

    `partition` is a column of both sides that is a function of the key; the
    batch's smallest and largest value prune the loaded side at the scan.
    """
    low = incoming.agg(F.min(partition)).scalar()
    high = incoming.agg(F.max(partition)).scalar()
    recent = loaded.filter((F.col(partition) >= low) & (F.col(partition) <= high))
    return not_loaded(incoming, recent, keys)


def not_in(incoming: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """SQL NOT IN: as `not_loaded`, but a NULL on either side keeps nothing of that comparison.

    A NULL among the loaded keys empties the result, and incoming NULL keys are dropped
    unless the loaded table is empty.
    """
    flags = loaded.agg(
        F.coalesce(F.bool_or(F.col(key).isNull()), F.lit(False)).alias("has_null"),
        (F.count(F.lit(1)) > 0).alias("has_rows"),
    ).agg(F.first(F.struct("has_null", "has_rows"))).scalar()
    kept = incoming.filter(~flags["has_null"] & (F.col(key).isNotNull() | ~flags["has_rows"]))
    return kept.join(loaded.select(key), key, "left_anti")


def only_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key exists in `known` (IN / EXISTS)."""
    return df.join(known.select(*keys), list(keys), "left_semi")


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows without a dimension row; a NULL key is an orphan too."""
    reference = dim.select(F.col(dim_key or key).alias(key))
    return fact.join(reference, key, "left_anti")


def new_or_expired(staged: DataFrame, current: DataFrame, expired: DataFrame, key: str) -> DataFrame:
    """Staged rows without a current version, or whose version has just been expired."""
    has_current = current.select(key).distinct().withColumn("_current", F.lit(True))
    has_expired = expired.select(key).distinct().withColumn("_expired", F.lit(True))
    return (
        staged.join(has_current, key, "left")
        .join(has_expired, key, "left")
        .filter(F.col("_current").isNull() | F.col("_expired"))
        .drop("_current", "_expired")
    )


def update_from(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str], when: Column | None = None
) -> DataFrame:
    """UPDATE ... FROM: overwrite `columns` of matching target rows.

    `when` may restrict it; it sees the two sides as ``t.`` and ``s.``. Keys are unique in `source`.
    """
    hit = F.col("s._hit").isNotNull()
    if when is not None:
        hit = hit & F.coalesce(when, F.lit(False))
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    marked = source.select(*keys, *columns).withColumn("_hit", F.lit(True))
    picked = [
        F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in columns else F.col(f"t.{c}")
        for c in target.columns
    ]
    return target.alias("t").join(marked.alias("s"), on, "left").select(*picked)


def _in_range(ts: Column, start: Column, end: Column) -> Column:
    return (ts >= start) & (end.isNull() | (ts < end))


def one_in_force(dim: DataFrame, spec: Versioned = CUSTOMER_VERSIONS) -> DataFrame:
    """Versions with `_from` and `_to` (NULL: open), cut so that at most one of an id is in force at any time.

    Of several the one that started last wins, then the one with the largest surrogate key, as ranking by start would say; after a
    short version inside a long one the long one goes on. Empty versions never are in force and go.

    One window over (id, start) parts an id's versions into islands that don't overlap each other. An island of one version is kept
    as it is; the others are swept in order of start (`_sweep`), each by itself, so an id is spread over its islands. Where nothing
    overlaps the exchange before the sweep is empty and the adaptive plan starts no Python worker.
    """
    start, end = F.col(spec.start), F.col(spec.end)
    far = F.coalesce(end, F.lit(_FOREVER).cast(dim.schema[spec.end].dataType))
    live = dim.filter(start.isNotNull() & (end.isNull() | (end > start)))
    ordered = W.partitionBy(spec.key).orderBy(spec.start, spec.surrogate)
    reach = F.max(far).over(ordered.rowsBetween(W.unboundedPreceding, -1))
    headed = live.withColumn("_head", F.coalesce(start >= reach, F.lit(True)))
    alone = F.col("_head") & F.coalesce(F.lead("_head").over(ordered), F.lit(True))
    island = F.last(F.when(F.col("_head"), start), ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, 0))
    parted = headed.withColumns({"_alone": alone, "_island": island})
    single = parted.filter("_alone").select(*dim.columns, start.alias("_from"), end.alias("_to"))
    several = parted.filter("not _alone").select(*dim.columns, "_island")
    rank = several.repartition(spec.key, "_island").sortWithinPartitions(spec.key, "_island", spec.start, spec.surrogate)
    edges = [StructField("_from", dim.schema[spec.start].dataType), StructField("_to", dim.schema[spec.end].dataType)]
    swept = rank.mapInArrow(_sweep(spec), StructType([*several.schema.fields, *edges]))
    return single.unionByName(swept.drop("_island"))


def _sweep(spec: Versioned):
    """One pass over sorted versions: the pieces of time in which each is the newest open one.

    A stack holds the open versions, the newest on top. A version that a newer one outlives never is in force again and leaves at once,
    so ends fall towards the top and every version is pushed and popped once. Memory holds one batch and the stack of one island.
    """

    def run(batches):
        import pyarrow as pa

        def ticks(column):
            whole = column.cast(pa.int32()) if pa.types.is_date32(column.type) else column
            return whole.cast(pa.int64()).to_pylist()

        left, stack, at, group = None, [], None, None
        pieces: list[tuple[int, int, int | None]] = []

        def advance(until):
            """Emit what is in force from `at` to `until` (None: for ever)."""
            nonlocal at
            while stack and (until is None or at < until):
                row, stop = stack[-1]
                if stop is not None and (until is None or stop <= until):
                    stack.pop()
                    if stop > at:
                        pieces.append((row, at, stop))
                        at = stop
                else:
                    pieces.append((row, at, until))
                    at = until
                    if until is None:
                        stack.clear()

        def flush(pool):
            first, last = pool.schema.field(spec.start).type, pool.schema.field(spec.end).type
            rows = pool.take(pa.array([p[0] for p in pieces], pa.int64()))
            edges = [_back(pa.array([p[k] for p in pieces], pa.int64()), t) for k, t in ((1, first), (2, last))]
            return pa.RecordBatch.from_arrays([*rows.columns, *edges], names=[*rows.schema.names, "_from", "_to"])

        def _back(values, kind):
            return (values.cast(pa.int32()) if pa.types.is_date32(kind) else values).cast(kind)

        for batch in (b for b in batches if b.num_rows):
            pool = batch if left is None else pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
            kept = 0 if left is None else left.num_rows
            starts, ends = ticks(batch.column(spec.start)), ticks(batch.column(spec.end))
            groups = zip(batch.column(spec.key).to_pylist(), ticks(batch.column("_island")))
            for row, (key, begin, stop) in enumerate(zip(groups, starts, ends), kept):
                if key != group:
                    advance(None)
                    group = key
                else:
                    advance(begin)
                at = begin
                while stack and stop is None or stack and stack[-1][1] is not None and stack[-1][1] <= stop:
                    stack.pop()
                stack.append((row, stop))
            if pieces:
                yield flush(pool)
                pieces.clear()
            left = pool.take(pa.array([row for row, _ in stack], pa.int64())) if stack else None
            stack = [(k, stop) for k, (_, stop) in enumerate(stack)]
        if stack:
            advance(None)
            yield flush(left)

    return run


def _few_versions(dim: DataFrame, spec: Versioned) -> bool:
    most = dim.groupBy(spec.key).count().agg(F.max("count")).first()[0]
    return (most or 0) <= MANY_VERSIONS


def large_dimension_strategy(dim: DataFrame, spec: Versioned = CUSTOMER_VERSIONS) -> str | None:
    """"join" for a dimension too large for a broadcast whose ids have few versions, so that facts cross one exchange by id; else the default."""
    slim = dim.select(*dict.fromkeys([spec.key, spec.start, spec.end, spec.current, spec.surrogate]))
    return "join" if not fits_broadcast(slim) and _few_versions(slim, spec) else None


def version_as_of(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    ts: str,
    spec: Versioned = CUSTOMER_VERSIONS,
    take: Sequence[str] = (),
    out: str = "_version",
    bucket: str = "day",
    write_facts: bool = True,
) -> DataFrame:
    """Add to each fact row the version in force at its time, as a struct (NULL when none is).

    Facts and version starts are merged in one sorted pass per (id, time bucket); no
    pair of a fact and a version it does not belong to is ever formed. The version in
    force at the start of a bucket is carried over from the last bucket that had one,
    so a hot id is spread over its buckets. Versions of one id must not overlap.

    The facts are read twice (their buckets, then their rows): they are written to the
    shared folder first unless ``write_facts=False`` says they already are a table.
    """
    if write_facts:
        fact = materialize(fact, "asof-facts")
    names = list(dict.fromkeys([spec.surrogate, *take]))
    version = F.struct(
        F.col(spec.start).alias("start"), F.col(spec.end).alias("end"), *[F.col(n) for n in names]
    )
    # an empty interval never matches: let the version that follows it at the same instant win
    rank = F.struct(
        F.col(spec.start), F.coalesce(F.col(spec.end) > F.col(spec.start), F.lit(True)), F.col(spec.surrogate)
    )
    starts = dim.filter(F.col(spec.start).isNotNull()).select(
        F.col(spec.key).alias("_id"), F.date_trunc(bucket, spec.start).alias("_cell"), version.alias("_v"), rank.alias("_r")
    )
    facts = fact.withColumn("_id", F.col(fact_key)).withColumn("_cell", F.date_trunc(bucket, ts))

    last = starts.groupBy("_id", "_cell").agg(F.max_by("_v", "_r").alias("_v"))
    cells = facts.select("_id", "_cell").distinct()
    # per (id, cell): the last version that started in an earlier cell
    earlier = W.partitionBy("_id").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        cells.join(last, ["_id", "_cell"], "full")
        .withColumn("_carry", F.last("_v", ignorenulls=True).over(earlier))
        .select("_id", "_cell", "_carry")
    )
    payload = F.struct(*[F.col(c) for c in fact.columns])
    merged = facts.select(
        "_id", "_cell", F.col(ts).alias("_t"), F.lit(1).alias("_kind"),
        payload.alias("_f"), F.lit(None).cast(starts.schema["_v"].dataType).alias("_v"),
        F.lit(None).cast(starts.schema["_r"].dataType).alias("_r"),
    ).unionByName(
        starts.select(
            "_id", "_cell", F.col("_r")[spec.start].alias("_t"), F.lit(0).alias("_kind"),
            F.lit(None).cast(_type_of(facts.select(payload.alias("p")))).alias("_f"), "_v", "_r",
        )
    )
    upto = W.partitionBy("_id", "_cell").orderBy("_t", "_kind", "_r").rowsBetween(W.unboundedPreceding, 0)
    matched = merged.withColumn("_seen", F.last("_v", ignorenulls=True).over(upto)).filter("_kind = 1")
    on = [F.col("m._id") == F.col("c._id"), F.col("m._cell") == F.col("c._cell")]
    found = F.coalesce("m._seen", "c._carry")
    valid = F.when(_in_range(F.col("m._t"), found["start"], found["end"]), found)
    return matched.alias("m").join(carried.alias("c"), on, "left").select("m._f.*", valid.alias(out))


def _type_of(one_column: DataFrame):
    return one_column.schema[0].dataType


def point_in_time_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    ts: str,
    spec: Versioned = CUSTOMER_VERSIONS,
    take: Sequence[str] = (),
    strategy: str | None = None,
    bucket: str = "day",
) -> DataFrame:
    """Inner join to the version with ``start <= ts < end`` (an open end is NULL).

    Where versions overlap the fact gets one of them, see `one_in_force`, so the strategy never changes the rows.
    strategy "broadcast" ships the dimension to the facts, "join" meets it on the id and tests every version of it, for a large dimension of few
    versions an id, "merge" is `version_as_of`. By default the dimension is broadcast only if its size estimate is under the session's threshold
    and no id has many versions, and else merged.
    """
    names = list(dict.fromkeys([spec.surrogate, *take]))
    slim = dim.select(*dict.fromkeys([spec.key, spec.start, spec.end, *names]))
    if strategy is None:
        strategy = "broadcast" if fits_broadcast(slim) and _few_versions(slim, spec) else "merge"
    slim = one_in_force(slim, spec)
    if strategy in ("broadcast", "join"):
        on = (F.col(f"f.{fact_key}") == F.col(f"d.{spec.key}")) & _in_range(F.col(f"f.{ts}"), F.col("d._from"), F.col("d._to"))
        found = F.broadcast(slim.alias("d")) if strategy == "broadcast" else slim.alias("d")
        return fact.alias("f").join(found, on).select(
            *[F.col(f"f.{c}") for c in fact.columns], *[F.col(f"d.{n}") for n in names]
        )
    versioned = version_as_of(fact, slim, fact_key, ts, replace(spec, start="_from", end="_to"), take, "_version", bucket)
    return versioned.filter("_version is not null").select(
        *fact.columns, *[F.col(f"_version.{n}").alias(n) for n in names]
    )


def asof_with_fallback(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    ts: str,
    spec: Versioned = CUSTOMER_VERSIONS,
    take: Sequence[str] = (),
    strategy: str | None = None,
    bucket: str = "day",
) -> DataFrame:
    """As `point_in_time_join`, but a fact outside every interval still finds a version.

    Preference: the version in force, else the current one, else the one that started last.
    The last two are one row per id, so the fallback join cannot multiply facts.
    `match` says which applied (1, 2 or 3); facts with an unknown id are dropped.
    """
    names = list(dict.fromkeys([spec.surrogate, *take]))
    slim = dim.select(*dict.fromkeys([spec.key, spec.start, spec.end, spec.current, *names]))
    if strategy is None:
        strategy = "broadcast" if fits_broadcast(slim) and _few_versions(slim, spec) else "merge"
    best = F.struct(F.coalesce(F.col(spec.current), F.lit(False)).alias("c"), F.col(spec.start).alias("s"), F.col(spec.surrogate).alias("k"))
    fallback = slim.groupBy(spec.key).agg(
        F.max_by(F.struct(F.coalesce(F.col(spec.current), F.lit(False)).alias("_cur"), *names), best).alias("_any")
    )
    cut = one_in_force(slim, spec)
    if strategy in ("broadcast", "join"):
        # a left join keeps late facts; at most one interval matches
        slim_v = cut.select(spec.key, F.struct(F.col("_from").alias("start"), F.col("_to").alias("end"), *names).alias("_version"))
        on = (F.col(f"f.{fact_key}") == F.col(f"d.{spec.key}")) & _in_range(
            F.col(f"f.{ts}"), F.col("d._version.start"), F.col("d._version.end")
        )
        slim_v = slim_v.alias("d")
        if strategy == "broadcast":
            slim_v, fallback = F.broadcast(slim_v), F.broadcast(fallback)
        versioned = fact.alias("f").join(slim_v, on, "left").select("f.*", "d._version")
    else:
        versioned = version_as_of(fact, cut, fact_key, ts, replace(spec, start="_from", end="_to"), take, "_version", bucket)
    known = versioned.join(
        fallback.withColumnRenamed(spec.key, "_fallback_id"), F.col(fact_key) == F.col("_fallback_id")
    )
    pick = [F.coalesce(F.col(f"_version.{n}"), F.when(F.col("_version").isNull(), F.col(f"_any.{n}"))).alias(n) for n in names]
    how = F.when(F.col("_version").isNotNull(), 1).when(F.col("_any._cur"), 2).otherwise(3)
    return known.select(*fact.columns, *pick, how.alias("match"))


def spine_join(spine: DataFrame, key: str, *sides: DataFrame) -> DataFrame:
    """Left join pre-aggregated sides to a date spine; keep dates where any side has a row."""
    marks = []
    for i, side in enumerate(sides):
        mark = f"_side{i}"
        marks.append(mark)
        spine = spine.join(side.withColumn(mark, F.lit(True)), key, "left")
    any_side = F.coalesce(*marks)
    return spine.filter(any_side).drop(*marks)
