"""Date keys, calendar parts and periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(ts: Column) -> Column:
    """yyyymmdd as an integer, by arithmetic (no string formatting per row)."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def date_from_key(key: Column) -> Column:
    return F.make_date(
        (key / 10000).cast("int"), ((key % 10000) / 100).cast("int"), key % 100
    )


def key_of(day: dt.date) -> int:
    """The key of a date known on the driver."""
    return day.year * 10000 + day.month * 100 + day.day


def day_of_week(d: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(d) - 1


def date_parts(d: Column) -> dict[str, Column]:
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "week": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "day_of_week": day_of_week(d),
    }


def month_day_names(d: Column, pad: bool = True) -> dict[str, Column]:
    """Full English names; ``pad`` keeps the blank padding to nine characters."""
    names = {"month_name": F.date_format(d, "MMMM"), "day_name": F.date_format(d, "EEEE")}
    if not pad:
        return names
    return {name: F.rpad(text, 9, " ") for name, text in names.items()}


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)


def date_series(start: Column, end: Column) -> Column:
    """One row per day, both ends included (a generator column)."""
    return F.explode(F.sequence(start, end, F.expr("interval 1 day")))


def period(d: Column) -> dict[str, Column]:
    return {
        "period_year": F.year(d),
        "period_month": F.month(d),
        "period_label": F.date_format(d, "yyyy-MM"),
    }


def month_start(key: Column) -> Column:
    """First day of the month a date key falls in."""
    return F.make_date((key / 10000).cast("int"), ((key % 10000) / 100).cast("int"), F.lit(1))


def as_of(day: dt.date | str) -> Column:
    """A run date given by the caller in place of the clock, so reruns agree."""
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return F.lit(day)
