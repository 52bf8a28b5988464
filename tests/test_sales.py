"""The sales star: how facts meet a customer dimension too large to broadcast, and what is written once."""

from datetime import datetime
from decimal import Decimal

import pytest

from starloom.plans.sales import build_sales_warehouse

FIRST, SECOND = datetime(2024, 1, 1), datetime(2024, 6, 1)


def _built(spark, **options):
    people = "raw_customer_id string, first_name string, last_name string, email string, customer_tier string, city string, state string, country string, updated_at timestamp"
    batches = [
        spark.createDataFrame([(i, "A", i, f"{i}@x.org", "Gold", "Rome", "", "IT", FIRST) for i in "abc"], people),
        spark.createDataFrame([("b", "A", "b", "b@x.org", "Silver", "Rome", "", "IT", SECOND)], people),
    ]
    products = spark.createDataFrame(
        [("p", "Pen", "Office", "Pens", Decimal("2.00"), Decimal("1.00"), FIRST)],
        "raw_product_id string, product_name string, category string, subcategory string, unit_price decimal(12,2), cost_price decimal(12,2), updated_at timestamp",
    )
    days = [datetime(2024, 2, 1), SECOND, datetime(2024, 7, 1), datetime(2023, 12, 31)]
    lines = [(f"o{i}", 1, c, p, days[i], 2, Decimal("5.00"), Decimal("0.00"), Decimal("1.00")) for i, (c, p) in enumerate([("b", "p"), ("b", "p"), ("a", "p"), ("c", "p")])]
    lines += [(*lines[0][:5], 3, *lines[0][6:]), ("o9", 1, "zz", "p", days[0], 1, *lines[0][6:]), ("o8", 1, "a", "none", days[0], 1, *lines[0][6:])]
    orders = spark.createDataFrame(
        lines, "order_id string, order_line_number int, customer_id string, product_id string, order_timestamp timestamp, quantity int, "
        "unit_price decimal(12,2), discount_amount decimal(12,2), tax_amount decimal(12,2)",
    )
    return build_sales_warehouse(spark, orders, products, batches, ("2023-01-01", "2024-12-31"), ids_trimmed=True, **options)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("late", [False, True])
def test_large_dimension_of_few_versions_is_joined_on_its_id(spark, rows, no_broadcast, late):
    facts = _built(spark, late=late).fact_sales
    assert "_cell" not in facts._jdf.queryExecution().optimizedPlan().toString()  # no sweep over days
    columns = ["order_id", "quantity", "customer_key"]
    assert rows(facts, *columns) == rows(_built(spark, late=late, strategy="merge").fact_sales, *columns)
    assert rows(facts, *columns) == rows(_built(spark, late=late, strategy="broadcast").fact_sales, *columns)
    assert facts.count() == (4 if late else 3)


def test_staging_is_written_once_for_callers_that_read_it(spark, rows):
    plain, written = _built(spark), _built(spark, write_staging=True)
    for name in ("stg_orders", "stg_products", "dim_product"):
        frame = getattr(written, name)
        assert frame.inputFiles() and "Window" not in frame._jdf.queryExecution().optimizedPlan().toString()
        assert rows(frame) == rows(getattr(plain, name))
    columns = ["order_id", "order_line_number", "customer_key", "product_key", "net_amount"]
    assert rows(plain.fact_sales, *columns) == rows(written.fact_sales, *columns)
