import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.operators.keys import dedupe_latest, dense_key, neighbour, ordered_key, sequence_key


def test_dense_keys_have_no_gaps_and_do_not_change(spark, rows):
    df = spark.range(5000).withColumn("name", F.concat(F.lit("n"), F.col("id").cast("string"))).repartition(7)
    keyed = dense_key(df, "k", ["id"], 100, buckets=13)
    assert sorted(r.k for r in keyed.select("k").collect()) == list(range(101, 5101))
    again = dense_key(df.repartition(3), "k", ["id"], 100, buckets=13)
    assert rows(keyed, "id", "k") == rows(again, "id", "k")


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.range(0), "k", ["id"]).count() == 0


def test_dense_key_is_pruned_when_unused(spark):
    keyed = dense_key(spark.range(10), "k", ["id"]).select("id")
    assert "Window" not in keyed._jdf.queryExecution().optimizedPlan().toString()


def test_ordered_key_equals_row_number(spark, rows):
    df = spark.range(3000).withColumn("v", (F.col("id") * 7919) % 1000).repartition(5)
    expected = df.withColumn("k", F.lit(10) + F.row_number().over(W.orderBy("v", "id")))
    assert rows(ordered_key(df, "k", ["v", "id"], 10), "id", "k") == rows(expected, "id", "k")


def test_sequence_key_is_unique(spark):
    keyed = sequence_key(spark.range(1000).repartition(4), "k", 5).agg(F.count_distinct("k"), F.min("k")).first()
    assert keyed[0] == 1000 and keyed[1] > 5


def test_latest_row_is_limited_before_the_exchange(spark):
    df = spark.range(10).withColumn("g", F.col("id") % 3)
    plan = dedupe_latest(df, ["g"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_bucketed_neighbours_equal_plain_ones(spark, rows):
    rng = random.Random(3)
    # one key holds most rows, times repeat, buckets are sometimes empty
    data = [(1 if rng.random() < 0.7 else rng.randint(2, 9), rng.randint(0, 400), i, rng.choice("abc")) for i in range(1500)]
    df = spark.createDataFrame(data, "k int, t int, i int, v string")
    for ahead in (False, True):
        plain = neighbour(df, ["k"], ["t", "i"], ["v", "t"], "n", ahead)
        split = neighbour(df, ["k"], ["t", "i"], ["v", "t"], "n", ahead, bucket=F.floor(F.col("t") / 17))
        assert rows(plain, "i", "n") == rows(split, "i", "n")


def test_written_keys_equal_the_others_and_evaluate_their_input_once(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(500).selectExpr("cast(id % 250 AS string) AS k", "id AS v", "CASE WHEN id % 7 = 0 THEN NULL ELSE id END AS w")
    counted = df.mapInPandas(noted, df.schema)
    got = dense_key(counted, "key", ["k", "v"], 10, written=True)
    assert rows(got) == rows(dense_key(df, "key", ["k", "v"], 10))
    assert seen.value == 500 and sorted(r.key for r in got.collect()) == list(range(11, 511))
    assert dense_key(df.limit(0), "key", ["k"], 3, written=True).count() == 0
