"""Dates of mixed precision, periods and edition identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval(date: Column, precision: Column) -> tuple[Column, Column]:
    """First and last day that a date of DAY, MONTH or YEAR precision may mean."""
    p = F.upper(precision)
    start = F.when(p == "YEAR", F.trunc(date, "year")).when(p == "MONTH", F.trunc(date, "month")).when(p == "DAY", F.to_date(date))
    end = F.when(p == "YEAR", F.last_day(F.add_months(F.trunc(date, "year"), 11))).when(p == "MONTH", F.last_day(date)).when(p == "DAY", F.to_date(date))
    return start, end


def overlaps(date: Column, precision: Column, start: Column, end: Column) -> Column:
    a, b = interval(date, precision)
    return (a <= end) & (b >= start)


def in_period(df: DataFrame, date: str, precision: str, start: str, end: str) -> DataFrame:
    """Rows whose date may fall in the closed period."""
    return df.filter(overlaps(F.col(date), F.col(precision), F.lit(start).cast("date"), F.lit(end).cast("date")))


def period_kind(start: Column, end: Column) -> Column:
    """day, month (a whole one), week (Monday to Sunday) or range."""
    return (
        F.when(start == end, "day")
        .when((start == F.trunc(start, "month")) & (end == F.last_day(start)), "month")
        .when((F.weekday(start) == 0) & (F.datediff(end, start) == 6), "week")
        .otherwise("range")
    )


def period_key(start: Column, end: Column) -> Column:
    kind = period_kind(start, end)
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), start).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(start).cast("string"), 2, "0"))
    return (
        F.when(kind == "day", F.date_format(start, "yyyy-MM-dd"))
        .when(kind == "month", F.date_format(start, "yyyy-MM"))
        .when(kind == "week", week)
        .otherwise(F.concat_ws("_", F.date_format(start, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd")))
    )


def period_complete(end: Column, as_of: Column) -> Column:
    """Whether the whole period lies before a day."""
    return end < as_of


def edition_identity(slug: Column, key: Column, revision: Column) -> Column:
    return F.format_string("%s__%s__r%02d", slug, key, revision)
