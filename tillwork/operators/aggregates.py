"""Aggregations.  All of them combine on the map side, so a hot group costs no task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.scalars import or_zero


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    return df.where(condition).agg(F.count(F.lit(1)).alias(name))


def count_distinct(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct counts, exact by default; ``approximate`` is the sketch for dashboards."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(f"n_{c}") for c in columns])


def sum_avg_or_zero(df: DataFrame, column: str) -> DataFrame:
    """Sum and mean that are 0, not NULL, over no rows."""
    total = F.sum(column)
    mean = total.cast("double") / F.nullif(F.count(column), F.lit(0))
    return df.agg(or_zero(total).alias("total"), F.coalesce(mean, F.lit(0.0)).alias("mean"))


def min_max_date(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    # min/max on the raw column first, one cast per group after
    low, high = F.min(ts).cast("date"), F.max(ts).cast("date")
    return df.groupBy(*by).agg(low.alias("min_date"), high.alias("max_date"))


def count_flag(df: DataFrame, flag: Column, by: Sequence[str], name: str = "n_flag") -> DataFrame:
    return df.groupBy(*by).agg(F.count_if(flag).alias(name))


def agg_by(df: DataFrame, keys: str | Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggs.items()])


def order_totals(items: DataFrame, key: str, price: str, freight: str) -> DataFrame:
    return agg_by(
        items,
        key,
        {
            "item_count": F.count(F.lit(1)),
            "total_value": F.sum(F.col(price) + F.col(freight)).cast("decimal(20,2)"),
            "total_freight": F.sum(freight).cast("decimal(20,2)"),
        },
    )


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def dupe_values(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    columns = [columns] if isinstance(columns, str) else list(columns)
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def has_dupes(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """One row: are there fewer distinct values than rows?"""
    columns = [columns] if isinstance(columns, str) else list(columns)
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.max("n") > 1, F.lit(False)).alias("has_dupes"))


def distinct(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def top_n(df: DataFrame, n: int, measure: str, label: str) -> DataFrame:
    """The n largest groups with their rank; ties go by label.

    The cut happens before the rank, so the unpartitioned window sees n rows.
    """
    from pyspark.sql import Window

    order = [F.desc(measure), F.col(label)]
    best = df.orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
