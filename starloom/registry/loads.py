"""Dimension merges, version joins, incremental fact loads, keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import sum_money
from ..operators.clean import clean_customers, clean_orders, clean_products
from ..operators.joins import (
    Versioned, asof_with_fallback, new_or_expired, not_in, not_loaded, not_loaded_since, only_known, orphans, point_in_time_join, update_from, version_as_of,
)
from ..operators.keys import dense_key, ordered_key, sequence_key
from ..operators.merge import insert_new, overlaps, scd2_changes, scd2_from_log, upsert, version_history
from ..operators.profile import one_row, table_counts
from ..plans import bindings as B
from ..plans.sales import (
    customer_dim_model, load_customers, load_products, product_dim, sales_facts, snapshot_customers,
)
from ..operators.clean import CUSTOMER_ATTRIBUTES
from ..session import materialize
from . import sql as S
from .core import query
from .reports import sales

_CUSTOMER_ROW = f"""customer_id, first_name, last_name, email, customer_tier, city, state, country,
  {S.instant('effective_start_date')} AS effective_start_date, {S.instant('effective_end_date')} AS effective_end_date, is_current"""


def customer_dim(spark, sf_dir) -> DataFrame:
    """Both customer batches merged one after the other, the state written between them."""
    first, second = [clean_customers(b) for b in B.customer_batches(spark, sf_dir)]
    return load_customers(materialize(load_customers(None, first), "dim_customer"), second)


@query("customer_dim_scd2", S.with_(S.DIM_CUSTOMER, select=f"SELECT {_CUSTOMER_ROW} FROM dim_customer"))
def customer_dim_scd2(spark, sf_dir) -> DataFrame:
    return customer_dim_model(customer_dim(spark, sf_dir)).drop("customer_key")


@query("customer_dim_one_pass", S.with_(S.DIM_CUSTOMER, select=f"SELECT {_CUSTOMER_ROW} FROM dim_customer"))
def customer_dim_one_pass(spark, sf_dir) -> DataFrame:
    """The same dimension from the whole batch history in one pass."""
    from ..plans.sales import customers_from_batches

    return customers_from_batches([clean_customers(b) for b in B.customer_batches(spark, sf_dir)]).drop("customer_key")


@query("scd2_replay", S.with_(S.DIM_CUSTOMER, select=f"SELECT {_CUSTOMER_ROW} FROM dim_customer"))
def scd2_replay(spark, sf_dir) -> DataFrame:
    """Merging the second batch twice changes nothing."""
    _, second = [clean_customers(b) for b in B.customer_batches(spark, sf_dir)]
    return load_customers(materialize(customer_dim(spark, sf_dir), "dim_customer"), second).drop("customer_key")


@query("scd2_history", S.with_(S.DIM_CUSTOMER, select=f"""
SELECT {_CUSTOMER_ROW} FROM dim_customer WHERE customer_id IN (SELECT customer_id FROM dim_customer GROUP BY customer_id HAVING COUNT(*) > 1)"""))
def scd2_history(spark, sf_dir) -> DataFrame:
    return version_history(materialize(customer_dim(spark, sf_dir), "dim_customer")).drop("customer_key").orderBy("customer_id", "effective_start_date")


@query("scd2_overlap", S.with_(S.DIM_CUSTOMER, select="""
SELECT COUNT(*) AS versions, COUNT(DISTINCT customer_id) AS customers, CAST(0 AS BIGINT) AS broken FROM dim_customer"""))
def scd2_overlap(spark, sf_dir) -> DataFrame:
    """Interval rule of the versioned dimension: nothing may overlap or leave a gap."""
    dim = materialize(customer_dim(spark, sf_dir), "dim_customer")
    broken = overlaps(dim).agg(F.count(F.lit(1)).alias("n")).scalar()
    return dim.agg(F.count(F.lit(1)).alias("versions"), F.count_distinct("customer_id").alias("customers")).withColumn("broken", broken)


@query("scd2_changes", S.with_(S.DIM_CUSTOMER, select="""
SELECT CASE WHEN effective_end_date IS NOT NULL THEN 'expire' WHEN effective_start_date > TIMESTAMP '1995-01-01' THEN 'insert' ELSE 'keep' END AS action,
  COUNT(*) AS n FROM dim_customer GROUP BY 1"""))
def scd2_changes_query(spark, sf_dir) -> DataFrame:
    first, second = [clean_customers(b) for b in B.customer_batches(spark, sf_dir)]
    dim = materialize(load_customers(None, first), "dim_customer")
    return scd2_changes(dim, second, CUSTOMER_ATTRIBUTES, "updated_at").groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("snapshot_check_subset", S.with_(S.DIM_CUSTOMER, select=f"""
SELECT customer_id, first_name, last_name, email, customer_tier, city, state, country, {S.instant('effective_start_date')} AS effective_start_date,
  {S.instant('effective_end_date')} AS effective_end_date, is_current FROM dim_customer"""))
def snapshot_check_subset(spark, sf_dir) -> DataFrame:
    """A snapshot that compares the tier alone; new versions have all columns."""
    first, second = [clean_customers(b) for b in B.customer_batches(spark, sf_dir)]
    dim = materialize(snapshot_customers(None, first, CUSTOMER_ATTRIBUTES), "snapshot")
    return snapshot_customers(dim, second, ["customer_tier"]).drop("customer_key")


@query("snapshot_check", S.with_(S.DIM_CUSTOMER, select="""
SELECT customer_id, COUNT(*) AS versions, MAX(CASE WHEN is_current THEN customer_tier END) AS tier FROM dim_customer GROUP BY 1"""))
def snapshot_check(spark, sf_dir) -> DataFrame:
    """Check-columns snapshot: only listed columns open a version."""
    first, second = [clean_customers(b) for b in B.customer_batches(spark, sf_dir)]
    dim = materialize(snapshot_customers(None, first, CUSTOMER_ATTRIBUTES), "snapshot")
    after = snapshot_customers(dim, second, CUSTOMER_ATTRIBUTES)
    return after.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("versions"), F.max(F.when(F.col("is_current"), F.col("customer_tier"))).alias("tier")
    )


EVENT_VERSIONS = Versioned("user_id", "version_key", "valid_from", "valid_to", "is_current")


def event_versions(spark, sf_dir) -> DataFrame:
    log = B.table(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    return scd2_from_log(log, ["event_type"], "ts", EVENT_VERSIONS, order=["event_id"])


_EVENT_LOG = """points AS (
  SELECT user_id, event_type, ts, event_id FROM (
    SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events) AS l
  WHERE prev IS NULL OR prev <> event_type),
versions AS (
  SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM points)"""


@query("scd2_event_log", f"""WITH {_EVENT_LOG}
SELECT user_id, event_type, {S.instant('ts')} AS valid_from, {S.instant('next_ts')} AS valid_to, next_ts IS NULL AS is_current FROM versions""")
def scd2_event_log(spark, sf_dir) -> DataFrame:
    """Every change of a log becomes a version, several per id and batch included."""
    return event_versions(spark, sf_dir).drop("version_key")


@query("scd2_event_log_incremental", f"""WITH {_EVENT_LOG}
SELECT user_id, event_type, {S.instant('ts')} AS valid_from, {S.instant('next_ts')} AS valid_to, next_ts IS NULL AS is_current FROM versions""")
def scd2_event_log_incremental(spark, sf_dir) -> DataFrame:
    """The same versions when the log arrives as two halves of the month."""
    log = B.table(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    half = F.lit("2024-01-16 00:00:00").cast("timestamp")
    dim = materialize(scd2_from_log(log.filter(F.col("ts") < half), ["event_type"], "ts", EVENT_VERSIONS, order=["event_id"]), "versions")
    return scd2_from_log(log.filter(F.col("ts") >= half), ["event_type"], "ts", EVENT_VERSIONS, order=["event_id"], dim=dim).drop("version_key")


@query("product_dim_scd1", f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
  CASE WHEN p_size >= 40 THEN p_type || ' LARGE' ELSE p_type END AS category, p_brand AS subcategory,
  CAST({S.money('p_retailprice')} + CASE WHEN p_size >= 40 THEN 10 ELSE 0 END AS DOUBLE) AS unit_price,
  CAST({S.money('p_retailprice * CAST(0.6 AS DOUBLE)')} AS DOUBLE) AS cost_price, TRUE AS is_active,
  CASE WHEN p_size >= 40 THEN '1998-01-01 00:00:00' ELSE '1995-01-01 00:00:00' END AS updated_at FROM part""")
def product_dim_scd1(spark, sf_dir) -> DataFrame:
    """Small parts first; then everything large arrives repriced: known ones are overwritten, the rest inserted."""
    everything = clean_products(B.stg_products(spark, sf_dir))
    known = everything.filter("category <> 'PROMO'")
    dim = materialize(load_products(None, known), "dim_product")
    repriced = clean_products(B.stg_products_repriced(spark, sf_dir).unionByName(B.stg_products(spark, sf_dir)))
    return load_products(dim, repriced).drop("product_key")


@query("product_dim_rebuild", S.with_(S.DIM_PRODUCT, select=f"""
SELECT product_key, product_id, product_name, category, subcategory, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(cost_price AS DOUBLE) AS cost_price, is_active, {S.instant('updated_at')} AS updated_at FROM dim_product"""))
def product_dim_rebuild(spark, sf_dir) -> DataFrame:
    """Keys equal ROW_NUMBER() OVER (ORDER BY product_id)."""
    return product_dim(clean_products(B.stg_products(spark, sf_dir)))


@query("ordered_keys", """
SELECT o_orderkey, 1000 + ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS sequence FROM orders""")
def ordered_keys(spark, sf_dir) -> DataFrame:
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ordered_key(orders, "sequence", ["o_orderdate", "o_orderkey"], 1000).select("o_orderkey", "sequence")


@query("surrogate_keys", """
SELECT 'dense' AS kind, COUNT(*) AS n, COUNT(*) AS distinct_keys, CAST(501 AS BIGINT) AS first_key, 500 + COUNT(*) AS last_key FROM orders""")
def surrogate_keys(spark, sf_dir) -> DataFrame:
    """Dense keys after a maximum: unique, no gaps."""
    keyed = dense_key(B.table(spark, sf_dir, "orders").select("o_orderkey"), "k", ["o_orderkey"], 500)
    return keyed.agg(
        F.lit("dense").alias("kind"), F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("distinct_keys"),
        F.min("k").alias("first_key"), F.max("k").alias("last_key"),
    )


@query("sequence_keys", "SELECT COUNT(*) AS n, COUNT(*) AS distinct_keys, TRUE AS after_start FROM lineitem")
def sequence_keys(spark, sf_dir) -> DataFrame:
    """Sequence keys: unique and after the start, gaps allowed."""
    keyed = sequence_key(B.table(spark, sf_dir, "lineitem").select("l_orderkey"), "k", 500)
    return keyed.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("distinct_keys"), (F.min("k") > 500).alias("after_start"))


_FACT_ROW = f"""order_id, {S.big('order_line_number')} AS order_line_number, customer_tier,
  {S.instant('effective_start_date')} AS effective_start_date, {S.big('order_date_key')} AS order_date_key, {S.big('quantity')} AS quantity,
  CAST(unit_price AS DOUBLE) AS unit_price, CAST(gross_amount AS DOUBLE) AS gross_amount, CAST(discount_amount AS DOUBLE) AS discount_amount,
  CAST(tax_amount AS DOUBLE) AS tax_amount, CAST(net_amount AS DOUBLE) AS net_amount, CAST(cost_amount AS DOUBLE) AS cost_amount,
  CAST(profit_amount AS DOUBLE) AS profit_amount, profit_margin_pct"""
_TAKE = ["customer_tier", "effective_start_date"]


def _fact_columns(fact: DataFrame) -> DataFrame:
    return fact.drop("sales_fact_key", "customer_key", "product_key", "created_at")


@query("fact_sales_pit", S.with_(*S.SALES, select=f"SELECT {_FACT_ROW} FROM fact_sales"))
def fact_sales_pit(spark, sf_dir) -> DataFrame:
    """Point-in-time fact load, dimension small enough to broadcast."""
    return _fact_columns(sales(spark, sf_dir, take=_TAKE).fact_sales)


@query("fact_sales_pit_merge", S.with_(*S.SALES, select=f"SELECT {_FACT_ROW} FROM fact_sales"))
def fact_sales_pit_merge(spark, sf_dir) -> DataFrame:
    """The same load by the sorted merge used for dimensions too large to broadcast."""
    return _fact_columns(sales(spark, sf_dir, take=_TAKE, strategy="merge").fact_sales)


# Three looks at the dimension in order of preference: the interval that holds the order, the open version, the newest one.
_ASOF = """in_force AS (
  SELECT order_id, order_line_number, arg_max(customer_key, effective_start_date) AS held_key
  FROM clean_orders AS o JOIN dim_customer AS c ON c.customer_id = o.customer_id
  WHERE effective_start_date <= order_timestamp AND coalesce(effective_end_date, TIMESTAMP '9999-12-31') > order_timestamp GROUP BY ALL),
newest AS (
  SELECT customer_id, arg_max(customer_key, effective_start_date) FILTER (is_current) AS open_key,
    arg_max(customer_key, effective_start_date) AS last_key FROM dim_customer GROUP BY customer_id),
versioned AS (
  SELECT o.*, c.customer_key, c.customer_tier, c.effective_start_date FROM clean_orders AS o
  JOIN newest AS n ON n.customer_id = o.customer_id
  LEFT JOIN in_force AS f ON f.order_id = o.order_id AND f.order_line_number = o.order_line_number
  JOIN dim_customer AS c ON c.customer_key = coalesce(f.held_key, n.open_key, n.last_key))"""
_LATE_SQL = S.with_(S.STG_ORDERS, S.CLEAN_ORDERS, S.DIM_PRODUCT, S.customers("1996-07-01"), _ASOF, S.measures("zero"), select=f"SELECT {_FACT_ROW} FROM fact_sales")


def _late(spark, sf_dir, strategy: str | None = None) -> DataFrame:
    from ..plans.sales import build_sales_warehouse

    w = build_sales_warehouse(
        spark, B.stg_orders(spark, sf_dir), B.stg_products(spark, sf_dir), B.customer_batches(spark, sf_dir, "1996-07-01 00:00:00"),
        B.SALES_CALENDAR, late=True, take=_TAKE, order_tiebreak=B.ORDER_TIES, ids_trimmed=True, strategy=strategy,
    )
    return _fact_columns(w.fact_sales)


@query("fact_sales_asof", _LATE_SQL)
def fact_sales_asof(spark, sf_dir) -> DataFrame:
    """Orders older than the first customer version fall back to the current one."""
    return _late(spark, sf_dir)


def _tangled(spark, sf_dir) -> DataFrame:
    """Versions of each customer that overlap, nest, are empty or start together."""
    c = B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    spans = [(1, "1992-01-01", "1998-01-01"), (2, "1995-06-01", None), (3, "1996-02-01", "1996-05-01"), (4, "1997-01-01", "1997-01-01"), (5, "1995-06-01", "1995-09-01"), (6, "1999-01-01", None)]
    made = [F.struct((F.col("customer_id") * 10 + k).alias("customer_key"), F.lit(a).cast("timestamp").alias("effective_start_date"), F.lit(b).cast("timestamp").alias("effective_end_date"), F.lit(k == 2).alias("is_current")) for k, a, b in spans]
    # Customers divisible by 7 have only their first version, so that later orders need the fallback.
    return c.select("customer_id", F.explode(F.when(F.col("customer_id") % 7 == 0, F.array(made[0])).otherwise(F.array(*made))).alias("v")).select("customer_id", "v.*")


def _tangled_sql(late: bool) -> str:
    inside = "o_orderdate >= a AND (b IS NULL OR o_orderdate < b)"
    rank = f"CASE WHEN {inside} THEN 1 WHEN cur THEN 2 ELSE 3 END"
    return f"""WITH spans(k, a, b, cur) AS (VALUES (1, TIMESTAMP '1992-01-01', TIMESTAMP '1998-01-01', false), (2, TIMESTAMP '1995-06-01', NULL, true),
  (3, TIMESTAMP '1996-02-01', TIMESTAMP '1996-05-01', false), (4, TIMESTAMP '1997-01-01', TIMESTAMP '1997-01-01', false),
  (5, TIMESTAMP '1995-06-01', TIMESTAMP '1995-09-01', false), (6, TIMESTAMP '1999-01-01', NULL, false))
SELECT o_orderkey, CAST(c_custkey * 10 + k AS BIGINT) AS customer_key{f", CAST({rank} AS BIGINT) AS match" if late else ""}
FROM orders JOIN customer ON o_custkey = c_custkey JOIN spans ON k = 1 OR c_custkey % 7 <> 0 {"" if late else f"WHERE {inside}"}
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY {rank}, a DESC, k DESC) = 1"""


def _tangled_query(strategy: str, late: bool):
    def run(spark, sf_dir) -> DataFrame:
        orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        find = asof_with_fallback if late else point_in_time_join
        found = find(orders, _tangled(spark, sf_dir), "o_custkey", "o_orderdate", strategy=strategy)
        return found.drop("o_custkey", "o_orderdate")

    run.__doc__ = f"Overlapping, nested and empty versions by {strategy}: one version for each order."
    return run


for _strategy in ("broadcast", "merge"):
    query(f"pit_tangled_{_strategy}", _tangled_sql(False))(_tangled_query(_strategy, False))
    query(f"asof_tangled_{_strategy}", _tangled_sql(True))(_tangled_query(_strategy, True))


@query("fact_sales_asof_merge", _LATE_SQL)
def fact_sales_asof_merge(spark, sf_dir) -> DataFrame:
    return _late(spark, sf_dir, "merge")


@query("version_as_of", f"""WITH {_EVENT_LOG}
SELECT e.event_id, (SELECT arg_max(v.event_type, v.ts) FROM versions AS v WHERE v.user_id = e.user_id AND v.ts <= e.ts - INTERVAL 1 HOUR) AS state_before
FROM events AS e""")
def version_as_of_query(spark, sf_dir) -> DataFrame:
    """The state of each user one hour before each event, against a dimension with many versions per id."""
    dim = materialize(event_versions(spark, sf_dir), "versions")
    probe = B.table(spark, sf_dir, "events").select(
        "event_id", "user_id", (F.col("ts").cast("timestamp") - F.expr("interval 1 hour")).alias("probe_ts")
    )
    found = version_as_of(probe, dim, "user_id", "probe_ts", EVENT_VERSIONS, ["event_type"], "v", write_facts=False)
    return found.select("event_id", F.col("v.event_type").alias("state_before"))


@query("fact_incremental", S.with_(*S.SALES, select=f"""
SELECT {S.big('order_date_key // 10000')} AS year, COUNT(*) AS new_rows, {S.total('net_amount')} AS net_amount
FROM fact_sales WHERE order_date_key >= 19980101 GROUP BY 1"""))
def fact_incremental(spark, sf_dir) -> DataFrame:
    """A rerun over all orders adds only those the first load had not seen."""
    w = sales(spark, sf_dir)
    loaded = materialize(w.fact_sales.filter("order_date_key < 19980101"), "fact_sales")
    orders = clean_orders(B.stg_orders(spark, sf_dir), B.ORDER_TIES, ids_trimmed=True)
    fresh = sales_facts(orders, w.dim_customer, w.dim_product, loaded)
    return fresh.groupBy(F.floor(F.col("order_date_key") / 10000).alias("year")).agg(
        F.count(F.lit(1)).alias("new_rows"), sum_money("net_amount").alias("net_amount")
    )


@query("not_exists", """
SELECT c_custkey FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')""")
def not_exists(spark, sf_dir) -> DataFrame:
    urgent = B.table(spark, sf_dir, "orders").filter("o_orderstatus = 'P' and o_orderpriority = '1-URGENT'")
    loaded = urgent.select(F.col("o_custkey").alias("c_custkey"))
    return not_loaded(B.table(spark, sf_dir, "customer").select("c_custkey"), loaded, ["c_custkey"])


@query("not_exists_recent", """
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND event_type <> 'click'""")
def not_exists_recent(spark, sf_dir) -> DataFrame:
    """The anti join reads only the part of the loaded table the batch's dates can touch."""
    events = B.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    batch = events.filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    loaded = events.filter("event_type = 'click'")
    return not_loaded_since(batch, loaded, ["event_id"], "ts").select("event_id")


@query("not_in", """
SELECT p_partkey, 'plain' AS kind FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)
UNION ALL SELECT p_partkey, 'with null' FROM part WHERE p_partkey NOT IN (SELECT CASE WHEN l_quantity > 45 THEN l_partkey END FROM lineitem)""")
def not_in_query(spark, sf_dir) -> DataFrame:
    """NOT IN, with and without NULLs among the loaded keys."""
    part, line = B.table(spark, sf_dir, "part").select("p_partkey"), B.table(spark, sf_dir, "lineitem")
    plain = line.filter("l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    holes = line.select(F.when(F.col("l_quantity") > 45, F.col("l_partkey")).alias("p_partkey"))
    return not_in(part, plain, "p_partkey").withColumn("kind", F.lit("plain")).unionByName(
        not_in(part, holes, "p_partkey").withColumn("kind", F.lit("with null"))
    )


@query("semi_join", """
SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def semi_join(spark, sf_dir) -> DataFrame:
    returned = B.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return only_known(B.table(spark, sf_dir, "orders"), returned, ["o_orderkey"]).select("o_orderkey")


@query("orphan_check", """
SELECT COUNT(*) AS orphan_lines FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size < 45 WHERE p_partkey IS NULL""")
def orphan_check(spark, sf_dir) -> DataFrame:
    known = B.table(spark, sf_dir, "part").filter("p_size < 45")
    lost = orphans(B.table(spark, sf_dir, "lineitem").select("l_partkey"), known, "l_partkey", "p_partkey")
    return lost.agg(F.count(F.lit(1)).alias("orphan_lines"))


@query("net_new_or_expired", """
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
  OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def net_new_or_expired(spark, sf_dir) -> DataFrame:
    orders = B.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    return new_or_expired(B.table(spark, sf_dir, "customer").select("c_custkey"), orders, orders.filter("o_orderstatus = 'P'"), "c_custkey")


@query("update_from_join", """
SELECT p.p_partkey, CASE WHEN s.m > p.p_retailprice THEN s.m ELSE p.p_retailprice END AS p_retailprice
FROM part AS p LEFT JOIN (SELECT l_partkey, MAX(l_extendedprice) AS m FROM lineitem WHERE l_quantity < 3 GROUP BY 1) AS s ON s.l_partkey = p.p_partkey""")
def update_from_join(spark, sf_dir) -> DataFrame:
    """UPDATE ... FROM with a change condition."""
    part = B.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    seen = B.table(spark, sf_dir, "lineitem").filter("l_quantity < 3").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_extendedprice").alias("p_retailprice"))
    return update_from(part, seen, ["p_partkey"], ["p_retailprice"], F.col("s.p_retailprice") > F.col("t.p_retailprice"))


@query("upsert_keys", """
SELECT COALESCE(o.user_id, n.user_id) AS user_id, COALESCE(n.last_value, o.last_value) AS last_value, COALESCE(o.first_type, n.first_type) AS first_type
FROM (SELECT user_id, arg_max(value, (ts, event_id)) AS last_value, arg_min(event_type, (ts, event_id)) AS first_type FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1) AS o
FULL JOIN (SELECT user_id, arg_max(value, (ts, event_id)) AS last_value, arg_min(event_type, (ts, event_id)) AS first_type FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1) AS n
ON o.user_id = n.user_id""")
def upsert_keys(spark, sf_dir) -> DataFrame:
    """Selected columns are refreshed, the others keep their first value, new keys are inserted."""
    e = B.table(spark, sf_dir, "events")
    at = F.struct("ts", "event_id")

    def state(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id").agg(F.max_by("value", at).alias("last_value"), F.min_by("event_type", at).alias("first_type"))

    old = state(e.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
    new = state(e.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")))
    return upsert(old, new, ["user_id"], ["last_value"])


@query("insert_new_members", """
SELECT COUNT(*) AS n, COUNT(DISTINCT s_nationkey) AS nations, COUNT(*) AS last_key FROM (SELECT DISTINCT s_nationkey FROM supplier) AS s""")
def insert_new_members(spark, sf_dir) -> DataFrame:
    """Insert-only dimension grown in two loads; keys stay dense and stable."""
    suppliers = B.table(spark, sf_dir, "supplier")
    members = suppliers.groupBy("s_nationkey").agg(F.min("s_name").alias("first_name"))
    indebted = suppliers.filter("s_acctbal < 0").groupBy("s_nationkey").agg(F.min("s_name").alias("first_name"))
    empty = spark.createDataFrame([], "nation_key bigint, s_nationkey int, first_name string")
    first = materialize(insert_new(empty, indebted, ["s_nationkey"], "nation_key"), "dim_nation")
    dim = first.unionByName(insert_new(first, members, ["s_nationkey"], "nation_key"))
    return dim.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("s_nationkey").alias("nations"), F.max("nation_key").alias("last_key"))


@query("kpi_panel", """
SELECT (SELECT COUNT(*) FROM orders) AS orders, (SELECT COUNT(*) FROM lineitem) AS lines, (SELECT COUNT(DISTINCT event_type) FROM events) AS event_types,
  (SELECT COUNT(*) FROM customer) AS customers, (SELECT strftime(MAX(o_orderdate), '%Y-%m-%d') FROM orders) AS last_order""")
def kpi_panel(spark, sf_dir) -> DataFrame:
    """Independent scalars on one row."""
    def count(name: str):
        return B.table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("n")).scalar()

    return one_row(
        spark,
        {
            "orders": count("orders"), "lines": count("lineitem"), "customers": count("customer"),
            "event_types": B.table(spark, sf_dir, "events").agg(F.count_distinct("event_type").alias("n")).scalar(),
            "last_order": B.table(spark, sf_dir, "orders").agg(F.to_date(F.max("o_orderdate")).alias("d")).scalar(),
        },
    )


_ALL = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations"]


@query("table_counts", " UNION ALL ".join([f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in _ALL] + ["SELECT 'missing_table', -1"]))
def table_counts_query(spark, sf_dir) -> DataFrame:
    tables = {t: B.table(spark, sf_dir, t) for t in _ALL}
    return table_counts({**tables, "missing_table": None})


@query("zero_activity", """
SELECT n_name, COUNT(DISTINCT c_custkey) FILTER (o_orderkey IS NULL) AS idle, COUNT(o_orderkey) AS orders,
  COALESCE(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS total
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n_name""")
def zero_activity(spark, sf_dir) -> DataFrame:
    """Members without facts stay with zero: orders are summed per customer before the outer joins."""
    orders = B.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("t")
    )
    people = B.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    joined = B.table(spark, sf_dir, "nation").join(people.join(orders, "c_custkey", "left"), "n_nationkey", "left")
    return joined.groupBy("n_name").agg(
        F.count(F.when(F.col("n").isNull(), F.col("c_custkey"))).alias("idle"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orders"), F.coalesce(F.sum("t").cast("double"), F.lit(0.0)).alias("total")
    )


@query("duplicate_keys", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def duplicate_keys(spark, sf_dir) -> DataFrame:
    lines = B.table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
