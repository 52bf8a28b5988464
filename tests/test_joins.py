import random
from datetime import datetime, timedelta

import pytest

from starloom import schemas
from starloom.operators import joins as J

D0 = datetime(2024, 1, 1)


def dim(spark, versions):
    """versions: (key, id, start day, end day, current)"""
    def at(d):
        return None if d is None else D0 + timedelta(days=d)

    data = [(k, i, None, None, None, f"t{k}", None, None, None, at(s), at(e), c) for k, i, s, e, c in versions]
    return spark.createDataFrame(data, schemas.DIM_CUSTOMER)


VERSIONS = [(1, "A", 10, 20, False), (2, "A", 20, None, True), (3, "B", 10, 15, False)]


def facts(spark, items):
    return spark.createDataFrame([(n, c, D0 + timedelta(days=d)) for n, c, d in items], "n int, cust string, ts timestamp")


ITEMS = [(1, "A", 9.5), (2, "A", 10), (3, "A", 19.9), (4, "A", 20), (5, "A", 400), (6, "B", 14), (7, "B", 15), (8, "B", 1), (9, "Z", 12)]


@pytest.mark.parametrize("strategy", ["broadcast", "merge"])
def test_point_in_time_boundaries(spark, rows, strategy):
    joined = J.point_in_time_join(facts(spark, ITEMS), dim(spark, VERSIONS), "cust", "ts", take=["customer_tier"], strategy=strategy)
    assert rows(joined, "n", "customer_key") == [(2, 1), (3, 1), (4, 2), (5, 2), (6, 3)]
    assert joined.columns == ["n", "cust", "ts", "customer_key", "customer_tier"]


@pytest.mark.parametrize("strategy", ["broadcast", "merge"])
def test_fallback_prefers_current_then_newest(spark, rows, strategy):
    joined = J.asof_with_fallback(facts(spark, ITEMS), dim(spark, VERSIONS), "cust", "ts", strategy=strategy)
    assert rows(joined, "n", "customer_key", "match") == [
        (1, 2, 2), (2, 1, 1), (3, 1, 1), (4, 2, 1), (5, 2, 1), (6, 3, 1), (7, 3, 3), (8, 3, 3),
    ]


def test_merge_equals_brute_force_with_a_hot_id(spark, rows):
    rng = random.Random(5)
    versions, key = [], 0
    for ident, n in (("hot", 60), ("b", 3), ("c", 1)):
        starts = sorted(rng.sample(range(0, 300), n))
        for s, e in zip(starts, [*starts[1:], None]):
            key += 1
            versions.append((key, ident, s, e, e is None))
    items = [(i, rng.choice(["hot", "hot", "hot", "b", "c"]), rng.randint(-5, 320) + rng.random()) for i in range(800)]
    merged = J.point_in_time_join(facts(spark, items), dim(spark, versions), "cust", "ts", strategy="merge", bucket="month")
    expected = sorted(
        ((i, k) for i, c, d in items for k, ident, s, e, _ in versions if c == ident and d >= s and (e is None or d < e)), key=str
    )
    assert rows(merged, "n", "customer_key") == expected


def test_default_strategy_by_size(spark):
    d = dim(spark, VERSIONS)
    assert J.point_in_time_join(facts(spark, ITEMS), d, "cust", "ts").count() == 5
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = J.point_in_time_join(facts(spark, ITEMS), d, "cust", "ts")._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_not_in_with_nulls(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(J.not_in(left, spark.createDataFrame([(1,)], "k int"), "k")) == [(2,)]
    assert rows(J.not_in(left, spark.createDataFrame([(1,), (None,)], "k int"), "k")) == []
    assert J.not_in(left, spark.createDataFrame([], "k int"), "k").count() == 3


def test_null_safe_not_loaded(spark, rows):
    left = spark.createDataFrame([(1,), (None,)], "k int")
    right = spark.createDataFrame([(None,)], "k int")
    assert rows(J.not_loaded(left, right, ["k"], null_safe=True)) == [(1,)]
    assert J.not_loaded(left, right, ["k"]).count() == 2


def test_spine_keeps_days_with_any_side(spark, rows):
    spine = spark.createDataFrame([(1,), (2,), (3,)], "d int")
    a = spark.createDataFrame([(1, 5)], "d int, a int")
    b = spark.createDataFrame([(2, None)], "d int, b int")
    assert rows(J.spine_join(spine, "d", a, b)) == [(1, 5, None), (2, None, None)]


def test_orphans_and_semi(spark, rows):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    known = spark.createDataFrame([(1,)], "k int")
    assert rows(J.orphans(fact, known, "k")) == [(2,), (None,)]
    assert rows(J.only_known(fact, known, ["k"])) == [(1,)]


def in_force_by_force(versions, day):
    """Key of the version in force: the one of those open that started last, then the largest key."""
    open_now = [(s, k) for k, _, s, e, _ in versions if s <= day and (e is None or day < e)]
    return max(open_now)[1] if open_now else None


@pytest.mark.parametrize("per_batch", [3, 10_000])
def test_overlapping_versions_are_swept_into_single_ones(spark, per_batch):
    rng = random.Random(per_batch)
    versions, key = [(900, "n", 5, 5, False), (901, "n", 5, 4, False)], 0
    for ident in "abcdefgh":
        for _ in range(rng.choice([1, 2, 25, 60])):
            key += 1
            s = rng.randint(0, 60)
            versions.append((key, ident, s, rng.choice([None, s, s + 1, s + rng.randint(1, 70), s + rng.randint(1, 5)]), False))
    # nested in each other, then a gap, then two that start together
    versions += [(500 + i, "nest", i, 60 - i, False) for i in range(20)] + [(600, "nest", 80, 90, False), (601, "nest", 80, 85, False)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    try:
        cut = J.one_in_force(dim(spark, versions)).select("customer_id", "customer_key", "_from", "_to").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for ident in {v[1] for v in versions}:
        mine = [v for v in versions if v[1] == ident]
        pieces = [r for r in cut if r["customer_id"] == ident]
        assert all(r["_to"] is None or r["_from"] < r["_to"] for r in pieces)
        for half in range(-2, 300):
            day = half / 2
            now = D0 + timedelta(days=day)
            found = [r["customer_key"] for r in pieces if r["_from"] <= now and (r["_to"] is None or now < r["_to"])]
            assert found == ([k] if (k := in_force_by_force(mine, day)) else [])


def test_a_hundred_thousand_overlapping_versions_of_one_id(spark):
    n = 100_000
    start = "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id)"
    versions = spark.range(n).selectExpr(
        "id as customer_key", "'hot' as customer_id", f"{start} as effective_start_date",
        f"timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, {2 * n} - id) as effective_end_date", "false as is_current",
    )
    cut = J.one_in_force(versions)
    # nested: every version is in force for its first second, and again when the one inside it has ended
    assert cut.count() == 2 * n - 1
    assert cut.groupBy("customer_key").count().agg({"count": "max"}).first()[0] == 2
