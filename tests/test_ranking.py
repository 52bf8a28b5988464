import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.operators import ranking as R


def test_ntile_equals_the_window_with_heavy_ties(spark, rows):
    rng = random.Random(1)
    # a third of the rows share one value
    data = [(f"c{i}", 5 if rng.random() < 0.4 else rng.randint(0, 50), rng.random() * 100) for i in range(2503)]
    df = spark.createDataFrame(data, "id string, a int, b double")
    measures = {"ta": [("a", True), ("id", True)], "tb": [("b", False), ("id", True)]}
    got = R.ntile_by_selection(df, 4, measures)
    expected = df.withColumns(
        {"ta": F.ntile(4).over(W.orderBy("a", "id")), "tb": F.ntile(4).over(W.orderBy(F.col("b").desc(), "id"))}
    )
    assert rows(got, "id", "ta", "tb") == rows(expected, "id", "ta", "tb")


def test_ntile_of_few_rows(spark, rows):
    for n in (0, 1, 2, 3, 5):
        df = spark.range(n).withColumn("v", F.col("id") * 2)
        got = R.ntile_by_selection(df, 4, {"t": [("v", True), ("id", True)]})
        assert rows(got, "id", "t") == rows(df.withColumn("t", F.ntile(4).over(W.orderBy("v", "id"))), "id", "t")


def test_ntile_over_every_kind_of_column(spark, rows):
    """Signs, extremes, decimals of many digits, texts that begin alike, infinities and NaN, up and down."""
    rng = random.Random(3)
    far = [Decimal("9" * 24 + ".99"), Decimal("-" + "9" * 24 + ".98"), Decimal("0.00"), Decimal("-0.01"), Decimal("1e18"), Decimal("-1e18")]
    reals = [float("inf"), float("-inf"), float("nan"), 0.0, -0.0, 1.7e308, -1.7e308, 5e-324, 1e-5]
    whole = [2**63 - 1, -(2**63), 0, -1]
    texts = ["", "a", "a\0", "Customer#000000001", "Customer#00000000", "é", "\U0001f600", "a" * 30]
    data = [
        (
            i, rng.choice([*far, Decimal(rng.randint(-10**6, 10**6)) / 100]), rng.choice([*reals, rng.uniform(-1, 1)]), rng.choice([*whole, rng.randint(-9, 9)]),
            rng.choice(texts), date(1969, 12, 1) + timedelta(days=rng.randint(0, 60)), datetime(1969, 12, 31) + timedelta(seconds=rng.randint(0, 10**6)),
        )
        for i in range(611)
    ]
    df = spark.createDataFrame(data, "id int, d decimal(38,2), x double, n bigint, s string, day date, ts timestamp")
    for up in (True, False):
        measures = {f"t_{c}": [(c, up), ("id", not up)] for c in ("d", "x", "n", "s", "day", "ts")}
        got = R.ntile_by_selection(df, 7, measures)
        assert got.columns == [*df.columns, *measures]

        def order(c):
            value = F.col(c) + 0.0 if c == "x" else F.col(c)  # -0.0 is 0.0
            return (value.asc(), F.col("id").desc()) if up else (value.desc(), F.col("id").asc())

        expected = df.withColumns({out: F.ntile(7).over(W.orderBy(*order(o[0][0]))) for out, o in measures.items()})
        assert rows(got, "id", *measures) == rows(expected, "id", *measures)


def test_ntile_takes_few_rounds(spark, monkeypatch):
    """The number of passes follows the digits of the values, not the rows or their ties."""
    df = spark.range(200_000).selectExpr("id", "id % 3 as few", "id * 7919 % 200003 as many")
    passes, narrow = [], R._narrow
    monkeypatch.setattr(R, "_narrow", lambda *a: passes.append(1) or narrow(*a))
    got = R.ntile_by_selection(df, 4, {"a": [("few", True), ("id", True)], "b": [("many", False), ("id", True)]})
    assert [r["count"] for r in got.groupBy("a").count().orderBy("a").collect()] == [50_000] * 4
    expected = df.withColumn("b", F.ntile(4).over(W.orderBy(F.col("many").desc(), "id")))
    assert got.select("id", "b").exceptAll(expected.select("id", "b")).isEmpty()
    assert len(passes) <= 4


def test_most_frequent_takes_the_smallest_on_a_tie(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, None), (2, "z"), (2, "z"), (2, "a")], "k int, v string")
    assert rows(R.most_frequent(df, ["k"], "v", "m")) == [(1, "a"), (2, "z")]


def test_top_groups(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    assert [tuple(r) for r in R.top_groups(df, ["k"], F.count(F.lit(1)), "n", 2).collect()] == [("a", 2), ("b", 1)]
