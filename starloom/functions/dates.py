"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import as_column


def date_key(value) -> Column:
    """YYYYMMDD as an integer."""
    return F.date_format(as_column(value), "yyyyMMdd").cast("int")


def month_label(value) -> Column:
    return F.date_format(as_column(value), "yyyy-MM")


def month_label_from_key(key) -> Column:
    """YYYY-MM from a YYYYMMDD integer; months of a date key need no join to the calendar."""
    col = as_column(key)
    return F.concat_ws(
        "-",
        F.lpad((F.floor(col / 10000)).cast("string"), 4, "0"),
        F.lpad((F.floor(col / 100) % 100).cast("string"), 2, "0"),
    )


def period_label(year, month) -> Column:
    return F.concat_ws(
        "-", as_column(year).cast("string"), F.lpad(as_column(month).cast("string"), 2, "0")
    )


def day_name(value) -> Column:
    return F.date_format(as_column(value), "EEEE")


def month_name(value) -> Column:
    return F.date_format(as_column(value), "MMMM")


def day_of_week(value, week_start: str = "iso") -> Column:
    """1..7 with Monday first ("iso") or Sunday first ("sunday")."""
    col = as_column(value)
    if week_start == "iso":
        return F.weekday(col) + F.lit(1)
    if week_start == "sunday":
        return F.dayofweek(col)
    raise ValueError(f"week_start must be 'iso' or 'sunday', not {week_start!r}")


def is_weekend(value) -> Column:
    return F.weekday(as_column(value)) >= 5


def is_month_start(value) -> Column:
    return F.dayofmonth(as_column(value)) == 1


def is_month_end(value) -> Column:
    col = as_column(value)
    return col == F.last_day(col)


def fiscal_quarter(value, start_month: int = 4) -> Column:
    return F.quarter(F.add_months(as_column(value), 1 - start_month))


def fiscal_year(value, start_month: int = 4) -> Column:
    return F.year(F.add_months(as_column(value), 1 - start_month))


def parse_instant(text) -> Column:
    """ISO text, with or without a trailing Z, to a timestamp; NULL when it is not one."""
    return F.try_to_timestamp(as_column(text))


def months_after(label, months) -> Column:
    """YYYY-MM label a number of months after another."""
    first = F.to_date(F.concat(as_column(label), F.lit("-01")))
    return F.date_format(F.add_months(first, as_column(months)), "yyyy-MM")


def next_weekdays(day, count: int) -> Column:
    """Array of the next `count` dates that are not Saturday or Sunday."""
    start = as_column(day)
    span = count + 2 * (count // 5 + 1) + 2
    days = F.sequence(F.date_add(start, 1), F.date_add(start, span), F.expr("interval 1 day"))
    return F.slice(F.filter(days, lambda d: F.weekday(d) < 5), 1, count)
