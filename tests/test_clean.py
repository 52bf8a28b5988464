from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from starloom.operators import clean as C
from starloom import schemas

T0, T1 = datetime(2024, 1, 1), datetime(2024, 2, 1)


def test_customers(spark, rows):
    stg = spark.createDataFrame(
        [
            (" C1 ", "Ann ", "Lee", " A@X.Com ", " ", "Rome", None, "IT", T0),
            ("C1", "Ann", "Lee", "a@x.com", "Gold", "Rome", None, "IT", T1),
            ("C2", "Bo", None, None, None, None, None, None, None),
            ("  ", "No", "Id", None, None, None, None, None, T0),
            (None, "No", "Id", None, None, None, None, None, T0),
        ],
        schemas.STG_CUSTOMERS,
    )
    clean = C.clean_customers(stg, F.lit(T1))
    assert rows(clean, "customer_id", "email", "customer_tier", "updated_at") == [("C1", "a@x.com", "Gold", T1), ("C2", None, "Standard", T1)]


def test_products(spark, rows):
    stg = spark.createDataFrame([("P1", "  Pen ", " ", None, None, Decimal("1.50"), T0), ("P1", "Old", "x", "y", Decimal(9), Decimal(9), None)], schemas.STG_PRODUCTS)
    assert rows(C.clean_products(stg)) == [("P1", "Pen", "Unassigned", "General", Decimal("0.00"), Decimal("1.50"), T0)]


def order(oid="O1", line=1, cid="C1", pid="P1", ts=T0, qty=2, price="3.00", disc=None, tax=None):
    return (oid, line, cid, pid, ts, qty, Decimal(price), disc, tax)


def test_orders_dedupe_and_defaults(spark, rows):
    stg = spark.createDataFrame(
        [order(), order(), order(ts=T1, qty=5), order(line=2, qty=0), order(line=3, qty=None), order(line=4, cid=" "), order(" O1", 5)],
        schemas.STG_ORDERS,
    )
    clean = C.clean_orders(stg)
    assert rows(clean, "order_id", "order_line_number", "quantity", "discount_amount") == [("O1", 1, 5, Decimal("0.00")), ("O1", 5, 2, Decimal("0.00"))]


def test_rejects_keep_every_row(spark, rows):
    stg = spark.createDataFrame([order(), order("nan"), order(cid=None, qty=-5), order(pid=" ")], schemas.STG_ORDERS)
    valid, rejects = C.split_rejects(stg, C.order_reject_rules())
    assert valid.count() == 1
    assert rows(rejects, "reject_reason") == [("invalid customer_id; invalid quantity",), ("invalid order_id",), ("invalid product_id",)]


def test_route_by_columns(spark):
    batch = spark.createDataFrame([("a", "1", "2", "x")], " City string, TEMP string, order_id string, quantity string")
    assert set(C.route(batch)) == {"weather", "orders"}
    assert C.route(batch)["orders"].columns == ["order_id", "quantity"]


def test_stock_aliases_and_ratios(spark, rows):
    batch = spark.createDataFrame([("abc", "2024-01-05T10:00", "10", None), ("nan", "2024-01-05", "1", "1")], "symbol string, date string, open string, close string")
    staged = C.stage_stocks(batch)
    assert [(r.ticker, str(r.trade_date), r.high_price, r.low_price, r.close_price, r.volume) for r in staged.collect()] == [
        ("ABC", "2024-01-05", 10.2, 9.8, 10.1, 1000000)
    ]


def test_weather_fallbacks(spark):
    batch = spark.createDataFrame([("Oslo", None, "7"), (None, "3", "3")], "city string, temperature string, avg_temp string")
    row, = C.stage_weather(batch, F.lit(T0)).collect()
    assert (row.temp_celsius, row.temp_min_c, row.temp_max_c, row.country_code, row.humidity_pct, row.observation_dt) == (7.0, 5.0, 9.0, "IND", 65, T0)


def test_bad_numbers_do_not_fail_the_batch(spark):
    batch = spark.createDataFrame([("O1", "C1", "P1", "two"), ("O2", "C1", "P1", "2.0")], "order_id string, customer_id string, product_id string, quantity string")
    assert [r.quantity for r in C.stage_orders(batch, F.lit(T0)).orderBy("order_id").collect()] == [None, 2]
