"""E-commerce star schema: dimensions, fact, and the whole load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import date_key
from ..operators.clean import CUSTOMER_ATTRIBUTES, PRODUCT_ATTRIBUTES, clean_customers, clean_orders, clean_products
from ..operators.joins import CUSTOMER_VERSIONS, MANY_VERSIONS, asof_with_fallback, not_loaded, point_in_time_join
from ..operators.keys import dense_key, max_key, ordered_key, sequence_key
from ..operators.measures import sales_measures
from ..operators.merge import scd1_merge, scd2_from_log, scd2_merge
from ..session import fits_broadcast, materialize
from ..sources.payloads import union_batches
from .calendar import date_dim

FACT_COLUMNS = [part.split()[0] for part in schemas.FACT_SALES.split(", ")]


def product_dim(clean: DataFrame) -> DataFrame:
    """Product dimension rebuilt from cleaned staging, keys dense in product_id order."""
    keyed = ordered_key(clean, "product_key", ["product_id"])
    return keyed.withColumn("is_active", F.lit(True)).select(*_names(schemas.DIM_PRODUCT))


def load_products(dim: DataFrame | None, clean: DataFrame, compare_cols: Sequence[str] | None = None, first_key: int | None = None) -> DataFrame:
    """Overwrite changed products, insert new ones. `dim` may be the part that the batch can touch, then with the largest key so far."""
    if dim is None:
        keyed = dense_key(clean, "product_key", ["product_id"])
        return keyed.withColumn("is_active", F.lit(True)).select(*_names(schemas.DIM_PRODUCT))
    return scd1_merge(
        dim, clean, "product_id", PRODUCT_ATTRIBUTES, "product_key", compare_cols, {"is_active": F.lit(True)}, "updated_at", first_key
    )


def load_customers(dim: DataFrame | None, clean: DataFrame, first_key: int | None = None) -> DataFrame:
    """Apply one batch of cleaned customers to the versioned dimension, or to the part that the batch can touch, then with the largest key so far."""
    if dim is None:
        first = clean.select(
            "customer_id", *CUSTOMER_ATTRIBUTES, F.col("updated_at").alias("effective_start_date"),
            F.lit(None).cast("timestamp").alias("effective_end_date"), F.lit(True).alias("is_current"),
        )
        return dense_key(first, "customer_key", ["customer_id"]).select(*_names(schemas.DIM_CUSTOMER))
    return scd2_merge(dim, clean, CUSTOMER_ATTRIBUTES, "updated_at", start=first_key)


def customers_from_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """The versioned dimension after several cleaned batches, built in one pass.

    Equals applying `load_customers` batch by batch when later batches carry later times. A batch
    has one row per customer, so a customer has at most as many rows as there are batches.
    """
    numbered = [batch.withColumn("_batch", F.lit(i)) for i, batch in enumerate(batches)]
    log = union_batches(numbered)
    versions = scd2_from_log(log, CUSTOMER_ATTRIBUTES, "updated_at", CUSTOMER_VERSIONS, order=["_batch"], bucket=None)
    return versions.select(*_names(schemas.DIM_CUSTOMER))


def snapshot_customers(dim: DataFrame | None, clean: DataFrame, check_cols: Sequence[str]) -> DataFrame:
    """As `load_customers`, but only a change in `check_cols` opens a version; others stay as first seen."""
    if dim is None:
        return load_customers(None, clean)
    return scd2_merge(dim, clean, list(check_cols), "updated_at")


def customer_dim_model(dim: DataFrame) -> DataFrame:
    """The published columns of the customer dimension."""
    return dim.select(*_names(schemas.DIM_CUSTOMER))


def sales_facts(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    loaded: DataFrame | None = None,
    late: bool = False,
    take: Sequence[str] = (),
    strategy: str | None = None,
    created_at: Column | None = None,
    dense: bool = False,
    first_key: int | None = None,
) -> DataFrame:
    """New rows of the sales fact for cleaned order lines.

    Each line gets the customer version in force at its time (``late=True``: with the current,
    then any version as fallback, and margin 0 for net <= 0). Lines already in `loaded` are left out
    before the joins. `take` adds customer columns. Fact keys are unique, and gap-free with ``dense=True``;
    they follow `first_key` where `loaded` is only the part of the fact that can hold a line of the batch.
    """
    if loaded is not None:
        orders = not_loaded(orders, loaded, ["order_id", "order_line_number"])
    find = asof_with_fallback if late else point_in_time_join
    versioned = find(orders, customers, "customer_id", "order_timestamp", CUSTOMER_VERSIONS, take, strategy)
    priced = versioned.join(products.select("product_id", "product_key", "cost_price"), "product_id")
    measured = sales_measures(priced, "zero" if late else "null").withColumns(
        {
            "order_date_key": date_key("order_timestamp"),
            "created_at": created_at if created_at is not None else F.current_timestamp(),
        }
    )
    start = first_key if first_key is not None else max_key(loaded, "sales_fact_key") if loaded is not None else 0
    if dense:
        keyed = dense_key(measured, "sales_fact_key", ["order_id", "order_line_number"], start, written=True)  # the joins run once
    else:
        keyed = sequence_key(measured, "sales_fact_key", start)
    return keyed.select(*FACT_COLUMNS, *take)


@dataclass
class SalesWarehouse:
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    fact_sales: DataFrame
    stg_orders: DataFrame
    stg_products: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.dim_date, "dim_customer": self.dim_customer,
            "dim_product": self.dim_product, "fact_sales": self.fact_sales,
        }


def build_sales_warehouse(
    spark: SparkSession,
    stg_orders: DataFrame,
    stg_products: DataFrame,
    customer_batches: Sequence[DataFrame],
    calendar: tuple[str, str],
    late: bool = False,
    take: Sequence[str] = (),
    order_tiebreak: Sequence[str] = (),
    ids_trimmed: bool = False,
    strategy: str | None = None,
    write_staging: bool = False,
) -> SalesWarehouse:
    """Staging to star schema: calendar, products, customer versions, then the fact.

    The customer dimension is written at its boundary (its true size then decides how
    facts join it); the fact stays lazy for the caller to write or to query. With few batches
    a customer has few versions, so facts meet them on the id and no sweep over days is needed.
    With `write_staging` the cleaned orders and products and the product dimension are written tables,
    for callers that read them as well.
    """
    dim_customer = materialize(customers_from_batches([clean_customers(b) for b in customer_batches]), "dim_customer")
    if strategy is None:  # at most one version per batch
        few = len(customer_batches) <= MANY_VERSIONS
        strategy = "merge" if not few else "broadcast" if fits_broadcast(dim_customer) else "join"
    products, orders = clean_products(stg_products), clean_orders(stg_orders, order_tiebreak, ids_trimmed)
    if write_staging:
        products, orders = materialize(products, "stg_products"), materialize(orders, "stg_orders")
    dim_product = load_products(None, products)
    if write_staging:
        dim_product = materialize(dim_product, "dim_product")
    facts = sales_facts(orders, dim_customer, dim_product, late=late, take=take, strategy=strategy)
    return SalesWarehouse(date_dim(spark, *calendar), dim_customer, dim_product, facts, orders, products)


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]
