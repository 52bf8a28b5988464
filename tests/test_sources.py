import json

import pytest
from pyspark.sql import functions as F

from starloom.sources import payloads as P
from starloom.sources.files import read_csv, read_external_csv, write_clustered, write_csv
from starloom.sources.sinks import preview, purge, replicate
from starloom.sources.store import TableStore

CSV = 'id,name,price,at\n1,"a, ""b""",1.50,2024-01-02 03:04:05\n2,NULL,null,\n3,x,cheap,2024-01-02 03:04:05\n4,y,1\n'


def test_csv_keeps_good_rows_and_reports_bad_ones(spark, tmp_path, rows):
    (tmp_path / "in_1.csv").write_text(CSV)
    (tmp_path / "other.txt").write_text("id\n9\n")
    good, bad = read_csv(spark, str(tmp_path), "id int, name string, price decimal(12,2), at timestamp", "in_*.csv")
    assert [(r.id, r.name, str(r.price), str(r["at"])) for r in good.orderBy("id").collect()] == [
        (1, 'a, "b"', "1.50", "2024-01-02 03:04:05"), (2, None, "None", "None"),
    ]
    assert rows(bad, "error") == [("bad price",), ("wrong number of fields",)]
    assert (good.count(), bad.count()) == (2, 2)


def test_external_csv_by_header_name(spark, tmp_path, rows):
    (tmp_path / "f.csv").write_text("extra,B,a\n1,2,3\n")
    assert rows(read_external_csv(spark, str(tmp_path), "a int, b int, c string")) == [(3, 2, None)]


def test_csv_export_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'q"uote, comma'), (2, None)], "id int, s string")
    write_csv(df, str(tmp_path / "out"))
    good, bad = read_csv(spark, str(tmp_path / "out"), "id int, s string")
    assert rows(good) == rows(df) and bad.count() == 0


def test_clustered_write_prunes(spark, tmp_path):
    df = spark.range(1000).select((F.lit(20240101) + F.col("id")).cast("int").alias("order_date_key"), F.col("id").alias("customer_key"), F.lit(1).alias("product_key"))
    write_clustered(df, str(tmp_path / "f"))
    back = spark.read.parquet(str(tmp_path / "f"))
    assert back.count() == 1000
    plan = back.filter("date_bucket = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_bucket" in plan


def test_bars_payload(spark, rows):
    body = json.dumps({P.BAR_SERIES: {"2024-01-02": {"1. open": "1.5", "4. close": "2", "5. volume": "7"}, "2024-01-03": {"1. open": "bad"}}})
    df = spark.createDataFrame([("abc", body)], "ticker string, payload string")
    got = {str(r.trade_date): (r.ticker, r.open_price, r.high_price, r.close_price, r.volume) for r in P.daily_bars(df).collect()}
    assert got == {"2024-01-02": ("ABC", 1.5, 0.0, 2.0, 7), "2024-01-03": ("ABC", 0.0, 0.0, 0.0, 0)}


def test_observation_payload(spark):
    good = {"cod": 200, "dt": 86400, "main": {"temp": 3.5}, "snow": {"1h": 0.4}, "weather": [], "sys": {}}
    df = spark.createDataFrame([("Oslo", json.dumps(good)), ("X", json.dumps({"cod": 401})), ("Y", "not json")], "city string, payload string")
    row, = P.observations(df).collect()
    assert (row.city, row.temp_celsius, row.snow_1h_mm, row.weather_main, row.country_code, str(row.observation_dt), row.humidity_pct) == (
        "Oslo", 3.5, 0.4, "", "", "1970-01-02 00:00:00", 0,
    )


def test_article_payload(spark):
    page = {"status": "ok", "articles": [
        {"title": "[Removed]"}, {"title": None}, {"title": "T", "source": None, "content": "x" * 600, "publishedAt": "2024-01-02T03:04:05Z"},
    ]}
    df = spark.createDataFrame([("tech", json.dumps(page)), ("bad", json.dumps({"status": "error"}))], "topic string, payload string")
    row, = P.articles(df).collect()
    assert (row.title, row.source_name, len(row.content), str(row.published_at), row.topic) == ("T", "Unknown", 500, "2024-01-02 03:04:05", "tech")


def test_union_fills_missing_columns(spark, rows):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "k")], "x int, y string")
    assert rows(P.union_batches([a, b])) == [(1, None), (2, "k")]


def test_store_publishes_all_or_nothing(spark, tmp_path, rows):
    store = TableStore(spark, str(tmp_path / "s"))
    txn = store.begin()
    txn.append("t", spark.range(3))
    assert store.read("t") is None
    txn.commit("stream", 4)
    assert store.manifest()["batches"] == {"stream": 4}
    txn = store.begin()
    txn.append("t", spark.range(10, 12))
    txn.replace("t", txn.read("t").filter("id <> 1"))
    before = store.read("t")
    txn.commit()
    assert before.count() == 3
    assert rows(store.read("t")) == [(0,), (10,), (11,), (2,)]


def test_store_refuses_a_lost_race(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    one, two = store.begin(), store.begin()
    one.append("t", spark.range(1))
    two.append("t", spark.range(2))
    one.commit()
    with pytest.raises(RuntimeError):
        two.commit()
    assert store.read("t").count() == 1


def test_replicate_and_purge(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "a"))
    txn = store.begin()
    txn.append("fact_weather_readings", spark.range(5))
    txn.append("raw_weather_observations", spark.range(7))
    txn.append("dim_location", spark.range(2))
    txn.commit()
    target = TableStore(spark, str(tmp_path / "b"))
    assert {(r.table_name, r.source_rows, r.target_rows) for r in replicate(store, target).collect()} == {
        ("fact_weather_readings", 5, 5), ("raw_weather_observations", 7, 7), ("dim_location", 2, 2),
    }
    assert {(r.table_name, r.deleted_rows) for r in purge(store, "weather").collect()} == {("fact_weather_readings", 5), ("raw_weather_observations", 7)}
    assert store.read("fact_weather_readings").count() == 0 and store.read("dim_location").count() == 2
    again = {(r.table_name, r.source_rows, r.target_rows) for r in replicate(store, target).collect()}
    assert ("fact_weather_readings", 0, 0) in again and target.read("fact_weather_readings").count() == 0


def test_preview_is_bounded_and_allow_listed(spark):
    tables = {"dim_date": spark.range(1000), "secret": spark.range(1)}
    assert preview(tables, "dim_date", 900).count() == 500
    with pytest.raises(ValueError):
        preview(tables, "secret")


def test_order_lines_carry_their_part_once_through_the_exchange(spark, tmp_path):
    from starloom.plans import bindings as B

    line = "1L l_orderkey, cast(null as bigint) l_partkey, 3L l_suppkey, 1 l_linenumber, 2D l_quantity, 10D l_extendedprice, 0.1D l_discount, 0.2D l_tax"
    rest = "'N' l_returnflag, 'O' l_linestatus, timestamp_ntz'1996-01-02' l_shipdate"
    lines = spark.sql(f"select {line}, {rest}")
    lines.unionByName(lines.withColumn("l_partkey", F.lit(7).cast("bigint"))).write.parquet(str(tmp_path / "lineitem.parquet"))
    order = "1L o_orderkey, 5L o_custkey, 'O' o_orderstatus, 1D o_totalprice, timestamp_ntz'1996-01-01' o_orderdate, '1' o_orderpriority"
    spark.sql(f"select {order}").write.parquet(str(tmp_path / "orders.parquet"))
    staged = B.stg_orders(spark, str(tmp_path))
    assert staged.columns[:4] == ["order_id", "order_line_number", "product_id", "quantity"]
    assert staged.columns[-2:] == ["customer_id", "order_timestamp"]
    assert {(r["order_id"], r["product_id"], r["l_partkey"]) for r in staged.collect()} == {("1", None, None), ("1", "7", 7)}
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("AS product_id") < plan.index("Join")
