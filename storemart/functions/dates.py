"""Date functions of the time dimension and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """Smart integer key yyyymmdd."""
    return F.date_format(d, "yyyyMMdd").cast("int")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def iso_week(d: Column) -> Column:
    """ISO-8601 week (Monday start, week 1 holds the first Thursday)."""
    return F.weekofyear(d)


def weekend_flag(d: Column) -> Column:
    """1 on Saturday/Sunday (Spark dayofweek: 1 = Sunday, 7 = Saturday)."""
    return F.dayofweek(d).isin(1, 7).cast("int")


def year_month_label(year: Column, month: Column) -> Column:
    """'yyyy-mm' (F09)."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def first_of_month(year: Column, month: Column) -> Column:
    """Date of the first day of a (year, month)."""
    return F.make_date(year, month, F.lit(1))


def run_stamp(ts: Column) -> Column:
    """Run timestamp → 'yyyyMMddHHmm' (report file name, F37)."""
    return F.date_format(ts, "yyyyMMddHHmm")
