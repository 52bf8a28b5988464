import random

from pyspark.sql import functions as F

from starloom.operators.joins import Versioned
from starloom.streaming import state

SPEC = Versioned("id", "version_key", "valid_from", "valid_to", "is_current")


def by_force(rows):
    out = []
    for at, order, payload in sorted(set(rows)):
        if not out or out[-1][2] != payload:
            out.append((at, order, payload))
    return {(a, o): (e, p) for (a, o, p), e in zip(out, [*[x[0] for x in out[1:]], None])}


def test_changes_in_any_order_end_in_the_versions_of_the_sorted_log():
    for seed in range(300):
        rng = random.Random(seed)
        rows = [(rng.randint(0, 40), o, rng.choice("abc")) for o in range(rng.randint(0, 25))]
        arrivals = sorted([*rows, *rng.sample(rows, len(rows) // 3)], key=lambda r: r[0] + rng.randint(0, 10))  # at most ten late
        held, table, seen, late = {"base": None, "rows": []}, {}, 0, 0
        while arrivals:
            batch, arrivals = arrivals[:4], arrivals[4:]
            horizon = seen - 11 if seen > 11 else None
            for action, at, order, end, payload in state.fold_changes(held, batch, horizon):
                if action == state.VERSION:
                    table[at, order] = (end, payload)
                elif action == state.GONE:
                    del table[at, order]
                else:
                    late += 1
            assert horizon is None or all(r[0] >= horizon for r in held["rows"])  # older changes are folded into one version
            seen = max(seen, *(r[0] for r in batch))
        assert late == 0 and table == by_force(rows)


def test_a_change_behind_the_horizon_is_late_and_moves_nothing():
    held = {"base": None, "rows": []}
    state.fold_changes(held, [(10, 0, "a"), (30, 0, "b")], None)
    assert state.fold_changes(held, [(5, 0, "z"), (20, 0, "a")], 15) == [(state.LATE, 5, 0, None, "z")]
    assert held == {"base": (10, 0, "a"), "rows": [(20, 0, "a"), (30, 0, "b")]}


def test_streamed_versions_with_nulls_late_rows_and_an_empty_drop(spark, tmp_path):
    schema = "id string, tier string, price decimal(9,2), ts timestamp, n int, action string"
    made = [
        [("A", "x", "1.10", "2024-01-01", 1), (None, "x", "1.10", "2024-01-01", 2), ("B", None, None, "2024-01-02", 3), ("A", "y", "2.00", "2024-01-05", 4), ("C", "x", "1.00", None, 5)],
        [],
        [("A", "z", "1.10", "2024-01-03", None), ("A", "y", "2.00", "2024-01-05", 4), ("B", "q", None, "2024-01-04 00:00:00.000001", 6), ("D", "d", "0.00", "2024-06-01", 7)],
        [("A", "w", "9.00", "2024-01-02", 8), ("D", "e", "0.00", "2024-05-30", 9)],
    ]
    folder = str(tmp_path / "drop")
    for rows in made:
        df = spark.createDataFrame(rows, "id string, tier string, price string, ts string, n int")
        df.select("id", "tier", F.col("price").cast("decimal(9,2)"), F.col("ts").cast("timestamp"), "n", F.lit("clash").alias("action")).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    changes = state.version_changes(stream, ["tier", "price"], "ts", SPEC, "n", "10 days")
    state.apply_changes(changes, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    tracked = spark.createDataFrame([], schema).select("tier", "price").schema
    found = state.versions_from(spark, str(tmp_path / "out"), changes.schema, tracked, SPEC).collect()
    got = sorted((r["id"], str(r["valid_from"]), r["tier"], str(r["price"]), str(r["valid_to"]), r["is_current"]) for r in found)
    assert got == [
        ("A", "2024-01-01 00:00:00", "x", "1.10", "2024-01-03 00:00:00", False),
        ("A", "2024-01-03 00:00:00", "z", "1.10", "2024-01-05 00:00:00", False),
        ("A", "2024-01-05 00:00:00", "y", "2.00", "None", True),
        ("B", "2024-01-02 00:00:00", None, "None", "2024-01-04 00:00:00.000001", False),
        ("B", "2024-01-04 00:00:00.000001", "q", "None", "None", True),
        ("D", "2024-05-30 00:00:00", "e", "0.00", "2024-06-01 00:00:00", False),
        ("D", "2024-06-01 00:00:00", "d", "0.00", "None", True),
    ]
    late = state.late_changes(spark, str(tmp_path / "out"), changes.schema, SPEC).collect()
    assert [(r["id"], str(r["changed_at"])) for r in late] == [("A", "2024-01-02 00:00:00")]


def test_the_files_of_a_delivery_do_not_follow_the_partitions_of_the_input(spark, tmp_path):
    from starloom.registry import stateful

    rows = spark.range(0, 600, numPartitions=12).withColumn("period", (F.col("id") % 3).cast("int"))
    stateful._arrive(rows, F.col("period"), F.col("id") % 7 == 0, str(tmp_path / "drop"))
    files = list((tmp_path / "drop").glob("*.parquet"))
    assert len(files) <= stateful.FILES * 5  # three periods, one late, one sent twice
    back = spark.read.schema(rows.schema).parquet(str(tmp_path / "drop"))
    assert back.distinct().count() == 600 and back.count() > 600
