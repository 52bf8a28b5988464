"""The table store: pruned reads, key filters, bucket-wise merges, manifests, upkeep and replication by difference."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.operators.joins import not_loaded
from starloom.sources import keyfilter
from starloom.sources.layout import Layout, identity_hash
from starloom.sources.maintain import compact, rebucket, vacuum
from starloom.sources.sinks import refresh_replica
from starloom.sources.store import CHECKPOINT_EVERY, TableStore
from starloom.streaming.batch import process_batch

LINES = {
    "lines": Layout(dated="day", identity=("id", "line"), ranges=("day",), surrogate="key"),
    "people": Layout(hashed=("name",), buckets=8, surrogate="key"),
}
IDENTITY = ["id", "line"]


def lines(spark, low, high, month):
    """Two lines for each id, on days of one month."""
    return spark.range(low, high).select(
        F.col("id").cast("string").alias("id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("line"), (F.lit(month * 100) + 1 + F.col("id") % 28).cast("int").alias("day")
    ).withColumn("key", (F.col("id").cast("long") * 2 + F.col("line")).cast("long"))


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, str(tmp_path / "s"), LINES)
    for k, month in enumerate((202401, 202402, 202403)):
        txn = made.begin()
        txn.append("lines", lines(spark, 1000 * k, 1000 * k + 500, month))
        txn.commit()
    return made


def test_filters_find_every_key_and_few_others(spark):
    held, other = spark.range(5000).withColumn("id", F.col("id").cast("string")), spark.range(5000, 40000).withColumn("id", F.col("id").cast("string"))
    slices = keyfilter.slices_for(5000)
    assert (keyfilter.slices_for(0), keyfilter.slices_for(1024), keyfilter.slices_for(1025), slices) == (1, 1, 2, 8)
    keys = held.select(F.lit("s").alias("segment"), F.lit(slices).cast("bigint").alias("slices"), identity_hash([F.col("id")]).alias("h"))
    filters = keyfilter.build(keys)
    assert filters.count() == slices

    def found(frame):
        return keyfilter.maybe(filters, frame.select(identity_hash([F.col("id")]).alias("h")), [slices, 1]).count()

    assert found(held) == 5000
    assert found(other) <= 4


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_filters_hold_one_row_a_key_until_its_bits_are_set(spark):
    keys = spark.range(3000).select(F.concat(F.lit("s"), F.col("id") % 3).alias("segment"), (F.col("id") % 3 * 2 + 1).alias("slices"), F.xxhash64("id").alias("h"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        built = keyfilter.build(keys.unionByName(keys.limit(50)))
        found = {(r["segment"], r["slices"], r["slice"]): bytes(r["bits"]) for r in built.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {}
    for r in keys.select("*", F.pmod("h", "slices").alias("slice"), keyfilter._probes(F.col("h")).alias("places")).collect():
        bits = expected.setdefault((r["segment"], r["slices"], r["slice"]), bytearray(keyfilter.SLICE_BITS // 8))
        for p in r["places"]:
            bits[p // 8] |= 1 << p % 8
    assert len(found) == built.count() == 9
    assert found == {k: bytes(v) for k, v in expected.items()}
    # ten rows a key were sorted in the task that read the segment
    assert "Generate" not in _plan(built) and "SortAggregate" not in _plan(built)
    assert keyfilter.build(keys.limit(0)).count() == 0


def test_a_key_is_looked_up_without_reading_its_slice_anew(spark):
    keys = spark.range(2000).select(F.xxhash64("id").alias("h"))
    filters = keyfilter.build(keys.select(F.lit("s").alias("segment"), F.lit(2).cast("bigint").alias("slices"), "h"))
    joined = keyfilter.maybe(filters, keys, [2])
    assert joined.distinct().count() == 2000
    above = _plan(joined).split("Join", 1)[1].split("\n", 1)[0]  # the join's line with its condition
    assert "lambda" not in above and "conv(" not in above


def test_a_batch_reads_the_segments_it_can_touch(spark, store):
    txn = store.begin()
    again = lines(spark, 1000, 1010, 202402).unionByName(lines(spark, 5000, 5010, 202404))
    loaded = txn.read_matching("lines", again)
    assert txn.reads == [("lines", 1, 3, 1000)]
    assert not_loaded(again, loaded, IDENTITY).count() == 20
    assert txn.read_matching("lines", lines(spark, 7000, 7100, 202401)).count() == 0
    # an id may come back with another day: the filter, not the month, decides
    assert not_loaded(lines(spark, 0, 5, 202405), txn.read_matching("lines", lines(spark, 0, 5, 202405)), IDENTITY).isEmpty()
    assert txn.high("lines") == 2 * 2499 + 2


def test_months_and_ranges_are_in_the_manifest(spark, store):
    txn = store.begin()
    txn.append("lines", lines(spark, 4000, 4010, 202402).unionByName(lines(spark, 4010, 4020, 202406)).unionByName(lines(spark, 4020, 4021, 202406).withColumn("day", F.lit(None).cast("int"))))
    txn.commit()
    parts = [(s["part"], s["rows"]) for s in store.manifest()["tables"]["lines"]["segments"]]
    assert parts == [(202401, 1000), (202402, 1000), (202403, 1000), (-1, 2), (202402, 20), (202406, 20)]
    last = store.manifest()["tables"]["lines"]["segments"][-1]
    assert (last["low"]["day"][:6], last["high"]["day"][:6]) == ("202406", "202406")
    assert store.read("lines").count() == 3042


def test_empty_writes_add_no_segment(spark, store):
    txn = store.begin()
    txn.append("lines", lines(spark, 0, 0, 202401))
    txn.append("fresh", spark.range(0))
    assert txn.commit() == 4
    tables = store.manifest()["tables"]
    assert len(tables["lines"]["segments"]) == 3 and tables["fresh"]["segments"] == []
    assert store.read("fresh").columns == ["id"] and store.read("fresh").count() == 0


def people(spark, names, tier="a"):
    return spark.createDataFrame([(n, tier, k) for k, n in enumerate(names)], "name string, tier string, key long")


def test_one_row_rewrites_one_bucket(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), LINES)
    txn = store.begin()
    txn.replace("people", people(spark, [f"p{i}" for i in range(200)]))
    txn.commit()
    before = {s["path"]: s["part"] for s in store.manifest()["tables"]["people"]["segments"]}
    assert len(before) == 8
    txn = store.begin()
    batch = people(spark, ["p7"], "b")
    own = txn.read_buckets("people", batch)
    assert own.count() < 60 and txn.reads[0][1] == 1
    txn.replace_buckets("people", own.filter("name <> 'p7'").unionByName(batch), txn.buckets("people", batch))
    txn.commit()
    after = {s["path"]: s["part"] for s in store.manifest()["tables"]["people"]["segments"]}
    assert len(set(before) & set(after)) == 7 and sorted(after.values()) == list(range(8))
    assert store.read("people").count() == 200 and store.read("people").filter("tier = 'b'").count() == 1
    with pytest.raises(ValueError):
        store.begin().replace_buckets("people", people(spark, [f"q{i}" for i in range(50)]), [0])


def test_manifests_hold_changes_and_checkpoints(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), {})
    for i in range(CHECKPOINT_EVERY + 3):
        txn = store.begin()
        txn.append("t", spark.range(i, i + 1))
        txn.commit("stream", i)
    log = tmp_path / "s" / "manifests"
    assert (log / f"{CHECKPOINT_EVERY:012d}.checkpoint.json").exists()
    sizes = [os.path.getsize(log / f"{v:012d}.json") for v in (2, CHECKPOINT_EVERY + 3)]
    assert sizes[1] < sizes[0] + 64  # a change doesn't grow with the table
    fresh = TableStore(spark, str(tmp_path / "s"), {})
    assert fresh.manifest() == store.manifest() and fresh.read("t").count() == CHECKPOINT_EVERY + 3
    assert len(fresh.manifest(4)["tables"]["t"]["segments"]) == 4 and fresh.manifest(4)["batches"] == {"stream": 3}
    with pytest.raises(ValueError):
        fresh.manifest(99)


def test_compaction_and_vacuum_under_a_reader(spark, store, rows):
    for k in range(3):
        txn = store.begin()
        txn.append("lines", lines(spark, 6000 + 10 * k, 6010 + 10 * k, 202403))
        txn.commit()
    reader, expected = store.read("lines"), rows(store.read("lines"))
    assert compact(store, small_rows=500) == {"lines": (6, 4)}
    assert compact(store, small_rows=500) == {}
    assert rows(reader) == expected == rows(store.read("lines"))
    txn = store.begin()
    assert txn.read_matching("lines", lines(spark, 6015, 6016, 202403)).count() == 60 and txn.reads[-1][1] == 1
    assert vacuum(store) == {}  # young files stay
    assert vacuum(store, keep_versions=10, min_age_seconds=-1) == {}  # earlier versions are kept
    # one load and its filter for each of the three small segments
    assert vacuum(store, keep_versions=1, min_age_seconds=-1) == {"lines": 6}
    assert rows(store.read("lines")) == expected


def test_vacuum_deletes_replaced_buckets_and_old_manifests(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), LINES)
    txn = store.begin()
    txn.replace("people", people(spark, [f"p{i}" for i in range(100)]))
    txn.commit()
    for i in range(CHECKPOINT_EVERY + 1):
        txn = store.begin()
        own = txn.read_buckets("people", people(spark, ["p3"]))
        txn.replace_buckets("people", own, txn.buckets("people", people(spark, ["p3"])))
        txn.commit()
    gone = vacuum(store, keep_versions=2, min_age_seconds=-1)
    assert gone == {"people": CHECKPOINT_EVERY}  # the first bucket and those between, without the last two
    assert store.read("people").count() == 100
    assert min(int(n.split(".")[0]) for n in store.log_names() if n.endswith(".json")) == CHECKPOINT_EVERY
    assert TableStore(spark, str(tmp_path / "s"), LINES).read("people").count() == 100


def test_rebucket_keeps_rows_and_prunes_by_the_new_buckets(spark, tmp_path, rows):
    store = TableStore(spark, str(tmp_path / "s"), LINES)
    txn = store.begin()
    txn.replace("people", people(spark, [f"p{i}" for i in range(100)]))
    txn.commit()
    expected = rows(store.read("people"))
    assert rebucket(store, "people", 32) > 8
    assert rows(store.read("people")) == expected
    txn = store.begin()
    own = txn.read_buckets("people", people(spark, ["p5"]))
    assert own.filter("name = 'p5'").count() == 1 and own.count() < 20
    txn.replace("people", own)
    assert txn.layout("people").buckets == 32


def test_replica_copies_new_segments_only(spark, store, tmp_path, rows):
    target = TableStore(spark, str(tmp_path / "r"), LINES)
    first = refresh_replica(store, target, ["lines", "absent"])
    assert first == {"lines": {"copied_segments": 3, "copied_rows": 3000, "dropped_segments": 0}}
    version = target.manifest()["version"]
    assert refresh_replica(store, target, ["lines"])["lines"]["copied_segments"] == 0 and target.manifest()["version"] == version
    txn = store.begin()
    txn.append("lines", lines(spark, 8000, 8005, 202409))
    txn.commit()
    assert refresh_replica(store, target, ["lines"])["lines"] == {"copied_segments": 1, "copied_rows": 10, "dropped_segments": 0}
    assert rows(target.read("lines")) == rows(store.read("lines"))
    txn = store.begin()
    txn.clear("lines")
    txn.commit()
    assert refresh_replica(store, target, ["lines"])["lines"]["dropped_segments"] == 4 and target.read("lines").count() == 0


def test_streamed_loads_touch_what_their_batch_touches(spark, tmp_path):
    """A later file of one customer reads and rewrites one bucket, and a replayed order line reads one month of facts."""
    from test_stream import CUSTOMER, ORDER, PRODUCT, wide

    clock = F.lit(datetime(2024, 12, 31))
    store = TableStore(spark, str(tmp_path / "s"))
    everything = [
        {**CUSTOMER, **PRODUCT, **ORDER, "customer_id": f"C{i}", "order_id": f"O{i}", "order_timestamp": f"2024-0{1 + i % 6}-02 00:00:00"} for i in range(60)
    ]
    assert process_batch(wide(spark, *everything), 0, store, as_of=clock) == "completed"
    before = store.manifest()["tables"]
    assert len(before["fact_sales"]["segments"]) == 6
    later = [{**CUSTOMER, "customer_id": "C5", "customer_tier": "Silver", "updated_at": "2024-03-01 00:00:00"}, everything[8]]
    assert process_batch(wide(spark, later[0]), 1, store, as_of=clock) == "completed"
    assert process_batch(wide(spark, later[1]), 2, store, as_of=clock) == "completed"
    after = store.manifest()["tables"]
    kept = {s["path"] for s in before["dim_customer"]["segments"]} & {s["path"] for s in after["dim_customer"]["segments"]}
    assert len(kept) >= len(before["dim_customer"]["segments"]) - 2
    assert store.read("fact_sales").count() == 60 and after["fact_sales"]["segments"] == before["fact_sales"]["segments"]
    versions = store.read("dim_customer").filter("customer_id = 'C5'").collect()
    assert sorted((v.customer_tier, v.is_current) for v in versions) == [("Gold", False), ("Silver", True)]
    keys = [r.customer_key for r in store.read("dim_customer").collect()]
    assert len(keys) == len(set(keys)) == 61 and max(keys) == after["dim_customer"]["high"]
