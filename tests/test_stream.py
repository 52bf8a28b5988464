import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.store import TableStore
from starloom.streaming.batch import SOURCE_FILE, SOURCE_TIME, process_batch
from starloom.streaming.ingest import ingest_files, wide_schema

CLOCK = datetime(2024, 12, 31)


def wide(spark, *records):
    names = wide_schema().names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], wide_schema())


ORDER = {"order_id": "O1", "order_line_number": "1", "customer_id": "C1", "product_id": "P1", "quantity": "2", "unit_price": "600", "order_timestamp": "2023-06-01 00:00:00"}
CUSTOMER = {"customer_id": "C1", "first_name": "Ann", "last_name": "Lee", "customer_tier": "Gold", "updated_at": "2024-01-01 00:00:00"}
PRODUCT = {"product_id": "P1", "product_name": "Pen", "cost_price": "1.00", "updated_at": "2024-01-01 00:00:00"}


def test_bare_ids_late_orders_replay_and_incremental_load(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))

    def run(i, *records):
        return process_batch(wide(spark, *records), i, store, as_of=F.lit(CLOCK))

    full = {**CUSTOMER, **PRODUCT, **ORDER}
    # older than the first customer version, still finds it; the alert names the customer
    assert run(0, full) == "completed"
    assert [(r.order_id, float(r.net_amount), r.order_date_key) for r in store.read("fact_sales").collect()] == [("O1", 1200.0, 20230601)]
    assert "Ann Lee" in store.read("alerts").first().message
    # the same line again and a new one, without any description of the known customer and product
    assert run(1, ORDER, {**ORDER, "order_line_number": "2"}) == "completed"
    assert sorted((r.order_line_number, r.sales_fact_key) for r in store.read("fact_sales").collect()) == [(1, 1), (2, 2)]
    assert [r.first_name for r in store.read("dim_customer").collect()] == ["Ann"]
    assert [float(r.cost_price) for r in store.read("dim_product").collect()] == [1.0]
    # an unknown bare customer loads its order; the description that follows supersedes it
    assert run(2, {**ORDER, "order_id": "O2", "customer_id": "C2"}) == "completed"
    assert run(3, {**CUSTOMER, "customer_id": "C2"}) == "completed"
    versions = store.read("dim_customer").filter("customer_id = 'C2'").orderBy("effective_start_date").collect()
    assert [(v.first_name, v.is_current) for v in versions] == [("", False), ("Ann", True)]
    assert store.read("fact_sales").count() == 3
    version = store.manifest()["version"]
    assert run(3, ORDER) == "skipped"
    assert store.manifest()["version"] == version


def test_csv_files_rejects_and_archive(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    head = "order_id,customer_id,product_id,quantity,unit_price"
    (drop / "a.csv").write_text(f"{head}\nO1,C1,P1,2,3.50\n,C1,P1,2,3.50\nO2,C1,P1,-5,1\n")
    (drop / "empty.csv").write_text(f"{head}\n")
    store = TableStore(spark, str(tmp_path / "s"))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in head.split(",")])
    options = dict(schema=schema, files_per_batch=1, as_of=F.lit(CLOCK))
    ingest_files(spark, str(drop), "csv", store, str(tmp_path / "c"), **options).awaitTermination()
    assert (store.read("stg_orders").count(), store.read("data_quality_log").count()) == (1, 2)
    # a restart reads nothing twice, a new file is picked up
    (drop / "b.csv").write_text(f"{head}\nO3,C1,P1,1,1\n")
    ingest_files(spark, str(drop), "csv", store, str(tmp_path / "c"), **options).awaitTermination()
    assert store.read("stg_orders").count() == 2
    assert store.read("pipeline_runs").filter("status = 'completed'").count() == 3


def test_bad_batch_is_set_aside_and_others_go_on(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    ambiguous = spark.createDataFrame([("x", "y")], "ticker string, `TICKER ` string")
    assert process_batch(ambiguous, 0, store) == "failed"
    assert store.read("quarantine").count() == 1
    assert store.read("pipeline_runs").first().status == "failed"
    bars = spark.createDataFrame([("abc", "2024-01-05", "10", "11"), ("abc", "2024-01-08", "11", "12.1")], "symbol string, date string, open string, close string")
    assert process_batch(bars, 1, store, as_of=F.lit(CLOCK)) == "completed"
    later = spark.createDataFrame([("abc", "2024-01-09", "12", "24.2")], "symbol string, date string, open string, close string")
    assert process_batch(later, 2, store, as_of=F.lit(CLOCK)) == "completed"
    returns = {r.date_key: r.daily_return_pct for r in store.read("fact_stock_prices").collect()}
    assert returns == {20240105: None, 20240108: 10.0, 20240109: 100.0}


def test_infrastructure_errors_are_raised_for_a_replay(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "s"))

    def lost(*args, **kwargs):
        raise OSError("executor lost")

    monkeypatch.setattr("starloom.streaming.batch.load_batch", lost)
    with pytest.raises(OSError):
        process_batch(wide(spark, ORDER), 0, store)
    assert store.manifest()["version"] == 0


def test_insights_and_replica(spark, tmp_path):
    store, replica = TableStore(spark, str(tmp_path / "s")), TableStore(spark, str(tmp_path / "r"))
    records = [{**CUSTOMER, **PRODUCT, **ORDER, "order_id": f"O{i}", "order_timestamp": f"2024-0{1 + i % 3}-02 00:00:00"} for i in range(6)]
    assert process_batch(wide(spark, *records), 0, store, as_of=F.lit(CLOCK), insights=True, replica=replica) == "completed"
    row = store.read("insights").first()
    assert row.revenue_forecast_status == "completed" and row.high_risk + row.medium_risk + row.low_risk == 1
    assert replica.read("fact_sales").count() == 6


def test_files_of_a_batch_are_routed_and_quarantined_one_by_one(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    too_much = {**ORDER, "order_id": "O9", "quantity": "2000000000", "unit_price": "9999999999.99"}  # beyond the money type
    files = [
        [{**CUSTOMER, "city": "Rome"}], [{"city": "Oslo", "temperature": "3.5", "observation_dt": "2024-01-05 00:00:00"}],
        [too_much, {**too_much, "order_id": "O8", "quantity": "1"}], [{**CUSTOMER, "customer_tier": "Silver", "updated_at": "2024-02-01 00:00:00"}], [ORDER],
    ]
    for k, records in enumerate(files):
        name = drop / f"{k}.json"
        name.write_text("\n".join(map(json.dumps, records)))
        os.utime(name, (1_700_000_000 + k, 1_700_000_000 + k))
    found = {}
    for n in (1, 100):
        store = TableStore(spark, str(tmp_path / f"s{n}"))
        ingest_files(spark, str(drop), "json", store, str(tmp_path / f"c{n}"), files_per_batch=n, as_of=F.lit(CLOCK)).awaitTermination()
        assert store.manifest()["batches"]["files"] == (4 if n == 1 else 0)
        found[n] = {
            name: sorted(tuple(r) for r in store.read(name).select(*columns).collect())
            for name, columns in {
                "raw_weather_observations": ("city", "temp_celsius"), "dim_customer": ("customer_id", "city", "customer_tier", "is_current"),
                "fact_sales": ("order_id",), "quarantine": ("record",), "pipeline_runs": ("status",),
            }.items()
        }
    assert found[1] == found[100]
    assert found[100]["raw_weather_observations"] == [("Oslo", 3.5)]
    assert found[100]["fact_sales"] == [("O1",)] and len(found[100]["quarantine"]) == 2
    assert sorted(r[2:] for r in found[100]["dim_customer"]) == [("Gold", False), ("Silver", True)]


def test_headers_that_clash_are_quarantined_by_file(spark, tmp_path):
    rows = spark.createDataFrame([("x", "y", "f1", CLOCK), ("x", "z", "f2", CLOCK)], f"ticker string, `TICKER ` string, {SOURCE_FILE} string, {SOURCE_TIME} timestamp")
    store = TableStore(spark, str(tmp_path / "s"))
    assert process_batch(rows, 0, store) == "failed"
    assert sorted(r.pipeline_run_id for r in store.read("quarantine").collect()) == ["files-0-0", "files-0-1"]
    assert all(r.error_message.startswith("f") for r in store.read("pipeline_runs").collect())
