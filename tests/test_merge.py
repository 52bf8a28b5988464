from datetime import datetime

from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import merge as M
from starloom.operators.clean import CUSTOMER_ATTRIBUTES
from starloom.plans.sales import customers_from_batches, load_customers, load_products

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


def batch(spark, *people):
    """people: (id, tier, city, time)"""
    data = [(i, "F", "L", "e", tier, city, None, None, ts) for i, tier, city, ts in people]
    return spark.createDataFrame(data, schemas.STG_CUSTOMERS.replace("raw_customer_id", "customer_id"))


COLUMNS = ("customer_id", "customer_tier", "city", "effective_start_date", "effective_end_date", "is_current")


def test_versions_after_two_batches(spark, rows):
    dim = load_customers(None, batch(spark, ("A", "Gold", "x", T1), ("B", "Gold", None, T1), ("C", "Gold", "x", T1)))
    dim = load_customers(dim, batch(spark, ("A", "Gold", "x", T2), ("B", "Gold", "y", T2), ("D", "New", "x", T2)))
    assert rows(dim, *COLUMNS) == sorted(
        [
            ("A", "Gold", "x", T1, None, True),
            ("B", "Gold", None, T1, T2, False),
            ("B", "Gold", "y", T2, None, True),
            ("C", "Gold", "x", T1, None, True),
            ("D", "New", "x", T2, None, True),
        ],
        key=str,
    )
    assert sorted(r.customer_key for r in dim.collect()) == [1, 2, 3, 4, 5]
    assert M.overlaps(dim).count() == 0
    assert {r.customer_id for r in M.version_history(dim).collect()} == {"B"}


def test_replay_and_stale_records_change_nothing(spark, rows):
    dim = load_customers(None, batch(spark, ("A", "Gold", "x", T2)))
    second = batch(spark, ("A", "Silver", "x", T3))
    dim = load_customers(dim, second)
    assert rows(load_customers(dim, second)) == rows(dim)
    assert rows(load_customers(dim, batch(spark, ("A", "Old", "x", T1)))) == rows(dim)


def test_one_pass_equals_batch_by_batch(spark, rows):
    batches = [
        batch(spark, ("A", "1", "x", T1), ("B", "1", "x", T1)),
        batch(spark, ("A", "2", "x", T2), ("C", "1", "x", T2)),
        batch(spark, ("A", "2", "x", T3), ("B", "9", "x", T3)),
    ]
    dim = None
    for b in batches:
        dim = load_customers(dim, b)
    assert rows(customers_from_batches(batches), *COLUMNS) == rows(dim, *COLUMNS)


def test_several_changes_in_one_batch(spark, rows):
    dim = load_customers(None, batch(spark, ("A", "1", "x", T1)))
    log = batch(spark, ("A", "2", "x", T2), ("A", "2", "x", datetime(2024, 2, 10)), ("A", "3", "x", T3), ("B", "7", "x", T3))
    after = M.scd2_from_log(log, CUSTOMER_ATTRIBUTES, "updated_at", M.CUSTOMER_VERSIONS, dim=dim)
    assert rows(after, *COLUMNS) == sorted(
        [
            ("A", "1", "x", T1, T2, False),
            ("A", "2", "x", T2, T3, False),
            ("A", "3", "x", T3, None, True),
            ("B", "7", "x", T3, None, True),
        ],
        key=str,
    )
    assert sorted(r.customer_key for r in after.collect()) == [1, 2, 3, 4]


def test_overlap_is_found(spark):
    dim = load_customers(None, batch(spark, ("A", "1", "x", T1)))
    again = dim.withColumns({"customer_key": F.lit(2).cast("bigint"), "effective_start_date": F.lit(T2)})
    assert M.overlaps(dim.unionByName(again)).count() == 1


def products(spark, *items):
    data = [(i, "n", cat, "s", price, 1, ts) for i, cat, price, ts in items]
    df = spark.createDataFrame(data, "product_id string, product_name string, category string, subcategory string, unit_price int, cost_price int, updated_at timestamp")
    return df.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("unit_price", "cost_price")})


def test_type_one_overwrites_and_inserts(spark, rows):
    dim = load_products(None, products(spark, ("P1", "a", 1, T1), ("P2", "a", 1, T1), ("P3", "a", 1, T2)))
    after = load_products(dim, products(spark, ("P1", "b", 1, T2), ("P2", "a", 1, T2), ("P3", "z", 9, T1), ("P4", "c", 4, T2)))
    got = {r.product_id: (r.category, r.updated_at, r.is_active) for r in after.collect()}
    assert got == {"P1": ("b", T2, True), "P2": ("a", T1, True), "P3": ("a", T2, True), "P4": ("c", T2, True)}
    keys = {r.product_id: r.product_key for r in after.collect()}
    assert sorted(keys.values()) == [1, 2, 3, 4] and keys["P4"] == 4


def test_type_one_with_fewer_compared_columns(spark):
    dim = load_products(None, products(spark, ("P1", "a", 1, T1)))
    after = load_products(dim, products(spark, ("P1", "b", 1, T2)), compare_cols=["unit_price", "cost_price", "product_name"])
    assert after.first().category == "a"


def test_upsert_modes(spark, rows):
    old = spark.createDataFrame([(1, "a", "x"), (None, "n", "x")], "k int, v string, w string")
    new = spark.createDataFrame([(1, None, "y"), (2, "b", "y"), (None, "m", "y")], "k int, v string, w string")
    assert rows(M.upsert(old, new, ["k"], ["v"])) == sorted([(1, None, "x"), (2, "b", "y"), (None, "m", "x")], key=str)
    assert rows(M.upsert(old, new, ["k"], [])) == sorted([(1, "a", "x"), (2, "b", "y"), (None, "n", "x")], key=str)
    assert rows(M.upsert(old, new, ["k"])) == sorted([(1, None, "y"), (2, "b", "y"), (None, "m", "y")], key=str)
