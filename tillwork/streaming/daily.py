"""Daily ingestion into a fact table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.dates import key_of
from tillwork.operators.merge import one_per_key


def daily_increment(
    target: DataFrame, rows: DataFrame, day: dt.date, date_key: str, keys: Sequence[str]
) -> DataFrame:
    """Target plus the day's rows whose key it does not hold yet.

    Only the target's rows of that day can collide, so only they are compared;
    the history is passed through without a shuffle.  Running a day twice adds
    nothing.
    """
    today = F.col(date_key) == key_of(day)
    fresh = one_per_key(rows.where(today), keys).join(
        target.where(today).select(*keys), list(keys), "left_anti"
    )
    return target.unionByName(fresh, allowMissingColumns=True).select(*target.columns)
