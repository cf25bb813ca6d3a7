"""Projection, typing, filtering and sorting."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.dates import key_of


# -- projections --------------------------------------------------------------


def project(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.select([expr.alias(name) for name, expr in columns.items()])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def with_literals(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def cast_strict(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """A value that does not fit fails the query (ANSI cast)."""
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})


def parse_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A value that is not a number becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


# -- filters ------------------------------------------------------------------


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def bad_dates(start: str, end: str, floor: dt.date, as_of: dt.date) -> Column:
    """End before start, start before the first valid day, or end after the run date."""
    s, e = F.col(start), F.col(end)
    return (e < s) | (s < F.lit(floor)) | (e > F.lit(as_of))


def where_any_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(any_null(columns))


def where_bad_dates(df: DataFrame, start: str, end: str, floor: dt.date, as_of: dt.date) -> DataFrame:
    return df.where(bad_dates(start, end, floor, as_of))


def where_month_key(df: DataFrame, key: str, year: int, month: int) -> DataFrame:
    """From day 1 up to, not including, day 31: a month's 31st is left out."""
    base = year * 10000 + month * 100
    return df.where((F.col(key) >= base + 1) & (F.col(key) < base + 31))


def where_month_key_half_open(df: DataFrame, key: str, year: int, month: int) -> DataFrame:
    """The whole month: from its first day up to, not including, the next month's first."""
    first = year * 10000 + month * 100 + 1
    after = first + 100 if month < 12 else (year + 1) * 10000 + 101
    return df.where((F.col(key) >= first) & (F.col(key) < after))


def where_optional(df: DataFrame, equals: Mapping[str, Any]) -> DataFrame:
    """Equality filters for the arguments that were given; ``None`` adds none."""
    for name, value in equals.items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    return df


def where_until(df: DataFrame, key: str, cutoff: dt.date) -> DataFrame:
    """Date key up to and including the cutoff, compared as integers so it reaches the scan."""
    return df.where(F.col(key) <= key_of(cutoff))


def where_in(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def where_between(df: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    return df.where(F.col(column).between(low, high))


def where_missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


# -- sorts --------------------------------------------------------------------


def sort(df: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    return df.orderBy(*keys)


def sort_limit(df: DataFrame, keys: Sequence[Column | str], n: int) -> DataFrame:
    return df.orderBy(*keys).limit(n)
