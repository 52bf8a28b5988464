from pyspark.sql import functions as F

from starloom.operators import quality as Q


def test_every_kind_of_check(spark):
    child = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (2, None, None), (None, "x", 3)], "id int, s string, n int")
    parent = spark.createDataFrame([(1,), (None,)], "pid int")
    checks = [
        Q.not_null("child", "s"), Q.accepted_values("child", "s", ["a", "b"]), Q.in_range("child", "n", low=0, severity="warning"),
        Q.unique("child", "id"), Q.relationship("child", "id", "parent", "pid"),
    ]
    got = {r.check_name: (r.records_checked, r.records_failed, r.status) for r in Q.run_assertions({"child": child, "parent": parent}, checks).collect()}
    assert got == {
        "not_null_s": (4, 1, "fail"),
        "accepted_values_s": (4, 1, "fail"),
        "range_n": (4, 1, "warn"),
        "unique_id": (4, 1, "fail"),
        "relationships_id_parent": (4, 2, "fail"),
    }


def test_empty_table_passes(spark):
    empty = spark.createDataFrame([], "id int, s string")
    results = Q.run_assertions({"t": empty}, [Q.not_null("t", "s"), Q.unique("t", "id")])
    assert {(r.records_checked, r.records_failed, r.status) for r in results.collect()} == {(0, 0, "pass")}


def test_no_alert_without_a_failed_record(spark):
    good = spark.createDataFrame([(1, "a")], "id int, s string")
    results = Q.run_assertions({"t": good}, [Q.not_null("t", "s")])
    assert Q.failure_alerts(results, "r").count() == 0
    assert Q.quality_log(results, "r").first().severity == "info"


def test_row_checks_of_a_table_share_one_scan(spark, tmp_path):
    spark.range(10).withColumn("s", F.lit("x")).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    plan = Q.run_assertions({"t": t}, [Q.not_null("t", "s"), Q.not_null("t", "id"), Q.in_range("t", "id", 0, 5)])
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
