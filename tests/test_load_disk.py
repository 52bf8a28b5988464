"""Loads of large batches: written in pieces, order lines in passes, nothing left on disk that no table refers to."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.plans import bindings as B
from starloom.registry import streams
from starloom.registry.cleaning import dirty_orders
from starloom.session import freed_shuffles, materialize, materialize_pieces, passing_scratch, plan_size, scratch_path
from starloom.sources.store import TableStore
from starloom.streaming import batch as loads
from starloom.streaming.batch import process_batch

CLOCK = datetime(2024, 12, 31)
LINE = "order_id string, order_line_number int, customer_id string, product_id string, quantity int, unit_price string, order_timestamp string, first_name string, cost_price string"


def lines(spark, numbers):
    rows = [(f" O{i // 3}" if i % 2 else f"O{i // 3}", i % 3, f"C{i % 4}", f"P{i % 5}", 1 + i % 7, f"{100 * i}.50", f"2023-0{1 + i % 9}-02 00:00:00", "Ann", "1.00") for i in numbers]
    return spark.createDataFrame(rows, LINE)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def scratch_left(spark):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "x")).getParent()
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(root)} if fs.exists(root) else set()


def loaded(spark, folder, *batches):
    store = TableStore(spark, str(folder))
    for k, batch in enumerate(batches):
        assert process_batch(batch, k, store, as_of=F.lit(CLOCK)) == "completed"
    return store


FACT = ("order_id", "order_line_number", "customer_key", "product_key", "order_date_key", "quantity", "net_amount", "profit_margin_pct")


def test_passes_and_pieces_load_what_one_load_does(spark, tmp_path, monkeypatch, rows):
    first, second = lines(spark, range(30)), lines(spark, range(20, 45))  # ten lines come again
    whole = loaded(spark, tmp_path / "whole", first, second)
    monkeypatch.setattr(loads, "PASS_ROWS", 15)
    parted = loaded(spark, tmp_path / "parted", [first.filter("order_line_number = 0"), first.filter("order_line_number > 0")], second)
    assert rows(parted.read("fact_sales"), *FACT) == rows(whole.read("fact_sales"), *FACT)
    assert sorted(r[0] for r in parted.read("fact_sales").select("sales_fact_key").collect()) == list(range(1, 46))
    for name, columns in {"stg_orders": ("order_id", "order_line_number"), "dim_customer": ("customer_id",), "dim_product": ("product_id",), "alerts": ("message",)}.items():
        assert rows(parted.read(name), *columns) == rows(whole.read(name), *columns)
    counted = ("records_extracted", "records_loaded", "records_transformed", "records_rejected")
    assert rows(parted.read("pipeline_runs"), *counted) == rows(whole.read("pipeline_runs"), *counted)


def test_a_load_leaves_only_its_tables_on_disk(spark, tmp_path):
    batch = lines(spark, range(30))
    files, scratch = shuffle_files(spark), scratch_left(spark)
    store = loaded(spark, tmp_path / "s", batch)
    left = shuffle_files(spark) - files
    for _ in range(20):  # they go in the background
        if not left:
            break
        time.sleep(0.5)
        left &= shuffle_files(spark)
    assert not left
    assert scratch_left(spark) <= scratch
    assert store.read("fact_sales").count() == 30


def test_scratch_passes_and_what_was_there_stays(spark):
    kept = materialize(spark.range(5), "kept")
    with passing_scratch(spark):
        inner = materialize(spark.range(7), "passing")
        with passing_scratch(spark):
            materialize(spark.range(9), "deeper")
        assert inner.count() == 7 and not [n for n in scratch_left(spark) if n.startswith("deeper-")]
    assert kept.count() == 5 and not [n for n in scratch_left(spark) if n.startswith("passing-")]
    assert [n for n in scratch_left(spark) if n.startswith("kept-")]


def test_freed_shuffles_puts_the_setting_back_and_frames_run_again(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), freed_shuffles(spark):
        frame = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
        assert len(frame.collect()) == len(frame.collect()) == 7
        raise ValueError
    assert spark.conf.get(key) == before


def test_pieces_of_other_columns_are_quarantined_whole(spark, tmp_path):
    good = lines(spark, range(4))
    with pytest.raises(ValueError):
        materialize_pieces([good, good.drop("quantity")])
    store = TableStore(spark, str(tmp_path / "s"))
    assert process_batch([good, good.drop("quantity")], 0, store) == "failed"
    assert store.read("quarantine").count() == 8 and store.read("pipeline_runs").first().status == "failed"


@pytest.fixture
def tables(spark, tmp_path):
    """Sixty lines of twelve orders; a twelfth of them each with quantity 1, 2, 13, 14 and 15."""
    at = datetime(1998, 6, 1)
    made = {
        "region": [(0, "R")], "nation": [(0, "N", 0)], "customer": [(i, f"c{i}", 0, 5.0 * i, "M") for i in range(4)],
        "part": [(i, f"p{i}", "B", "T", i, 10.0 + i) for i in range(5)],
        "orders": [(i, i % 4, "O", 1.0, datetime(1997 + i % 3, 1 + i, 3), "1") for i in range(12)],
        "lineitem": [(i % 12, i % 5, 0, i // 12, float([1, 2, 13, 14, 15, 20][i % 6]), 300.0 + i, 0.05, 0.02, "A", "F", at) for i in range(60)],
    }
    for name, data in made.items():
        spark.createDataFrame(data, B.TABLES[name]).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_records_are_dealt_into_pieces_by_order(spark, tables, monkeypatch, rows):
    """Also the pieces of dirty orders; the calendar's lines are those of one batch."""
    one = streams._in_pieces(spark, tables, streams._order_records(spark, tables))
    calendar = rows(streams_calendar(spark, tables))
    monkeypatch.setattr(streams, "PIECE_BYTES", plan_size(B.table(spark, tables, "lineitem")) // 3 + 1)
    for whole in (streams._order_records(spark, tables), dirty_orders(spark, tables).drop(*B.ORDER_TIES)):
        pieces = streams._in_pieces(spark, tables, whole)
        assert len(pieces) == 3 and all(p.count() < whole.count() for p in pieces)
        assert sorted((r for p in pieces for r in rows(p)), key=str) == rows(whole)
        assert rows(materialize_pieces(pieces)) == rows(whole)
    assert len(one) == 1 and rows(streams_calendar(spark, tables)) == calendar
    assert sum(r[-1] for r in calendar) == 60


def streams_calendar(spark, folder):
    from starloom.registry.runs import stream_calendar

    return stream_calendar(spark, folder).select("date_key", "day_name", "quarter", "orders")


def test_rejects_and_records_in_pieces(spark, tables, monkeypatch):
    monkeypatch.setattr(streams, "PIECE_BYTES", plan_size(B.table(spark, tables, "lineitem")) // 3 + 1)
    monkeypatch.setattr(loads, "PASS_ROWS", 40)
    seen = []
    apply = streams.process_batch
    monkeypatch.setattr(streams, "process_batch", lambda batch, *a, **k: seen.append(len(batch)) or apply(batch, *a, **k))
    assert tuple(streams.stream_rejects(spark, tables).first()) == (50, 10, "completed", 2)
    assert tuple(streams.record_batches(spark, tables).first()) == (60, 4, 5, 60, "skipped")
    assert seen == [3, 3, 3, 3]
