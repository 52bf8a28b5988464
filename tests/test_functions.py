import pytest
from pyspark.sql import functions as F

from starloom.functions import dates as D
from starloom.functions import numbers as N
from starloom.functions import text as X
from starloom.plans.calendar import core_date_dim, date_dim


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def test_rounding_does_not_depend_on_binary_ties(spark):
    assert one(spark, N.round_half_up(F.lit(1.005), 2)) == 1.01
    assert one(spark, N.round_half_up(F.lit(-2.5), 0)) == -3.0


def test_ratio_of_zero_is_null(spark):
    assert one(spark, N.percent(F.lit(1), F.lit(0))) is None
    assert one(spark, N.percent(F.lit(1), F.lit(3))) == 33.33


def test_clamp(spark):
    assert one(spark, N.clamp(F.lit(7.0), 1.0, 5.0)) == 5.0
    assert one(spark, N.clamp(F.lit(-7.0), 1.0, 5.0)) == 1.0


@pytest.mark.parametrize("text,usable", [(None, False), ("", False), ("  ", False), (" NaN ", False), ("None", False), ("null", False), ("x", True)])
def test_has_key(spark, text, usable):
    assert one(spark, X.has_key(F.lit(text).cast("string"))) is usable


def test_words_slug_tokens(spark):
    assert one(spark, X.word_count(F.lit(" a b  c "))) == 4
    assert one(spark, X.slug(F.lit("The Daily Post"))) == "the-daily-post"
    assert sorted(one(spark, X.token_set(F.lit(" Red red  Blue")))) == ["blue", "red"]


def test_fiscal_calendar(spark):
    rows = {str(r.full_date): r for r in date_dim(spark, "2024-03-31", "2024-04-01").collect()}
    assert (rows["2024-03-31"].fiscal_quarter, rows["2024-03-31"].fiscal_year) == (4, 2023)
    assert (rows["2024-04-01"].fiscal_quarter, rows["2024-04-01"].fiscal_year) == (1, 2024)
    assert rows["2024-03-31"].is_month_end and rows["2024-04-01"].is_month_start
    assert rows["2024-03-31"].day_of_week == 7 and rows["2024-03-31"].is_weekend


def test_calendar_year_variant_and_sunday_start(spark):
    row = date_dim(spark, "2024-03-31", "2024-03-31", "sunday", 1).first()
    assert (row.day_of_week, row.fiscal_quarter, row.fiscal_year) == (1, 1, 2024)
    assert core_date_dim(spark).count() == 1096
    assert date_dim(spark).count() == 4018


def test_next_weekdays_skip_weekend(spark):
    days = one(spark, D.next_weekdays(F.lit("2024-01-05").cast("date"), 3))
    assert [str(d) for d in days] == ["2024-01-08", "2024-01-09", "2024-01-10"]
    assert len(one(spark, D.next_weekdays(F.lit("2024-01-05").cast("date"), 14))) == 14


def test_month_arithmetic_and_instants(spark):
    assert one(spark, D.months_after(F.lit("2024-11"), F.lit(3))) == "2025-02"
    assert str(one(spark, D.parse_instant(F.lit("2024-01-02T03:04:05Z")))) == "2024-01-02 03:04:05"
    assert one(spark, D.parse_instant(F.lit("soon"))) is None
