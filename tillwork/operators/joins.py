"""Joins.

None of these forces a broadcast of a table that grows: the optimizer and
adaptive execution choose broadcast or sort-merge from measured sizes.  A hint
is used only for a side that is small by construction.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.scalars import hash_bucket

# Traffic shares have two decimals of a percent.
ALLOCATION_STEPS = 10_000


def join(left: DataFrame, right: DataFrame, key: str | Sequence[str], how: str = "inner") -> DataFrame:
    return left.join(right, key, how)


def resolve_dims(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Inner-join a fact to several dimensions in turn; rows without a match drop out."""
    for dim, key in dims:
        fact = fact.join(dim, key)
    return fact


def left_join_agg(left: DataFrame, agg: DataFrame, key: str, zero_cols: Sequence[str]) -> DataFrame:
    """Left join to a table already grouped by ``key``; missing measures become 0."""
    joined = left.join(agg, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero_cols})


def left_join_ranked(left: DataFrame, ranked: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return left.join(ranked, key, "left")


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row table on every row of ``df``.

    The one row is a scalar subquery: it runs first and goes into the plan as
    a value, so there is no join.  A second row fails the query; an empty
    table leaves no rows, as a cross join would.
    """
    single = one_row.select(F.struct(*one_row.columns).alias("one")).scalar()
    return (
        df.withColumn("__one", single)
        .where(F.col("__one").isNotNull())
        .select(*df.columns, *[F.col(f"__one.{c}").alias(c) for c in one_row.columns])
    )


def join_bucket(
    df: DataFrame,
    variants: DataFrame,
    key: Column,
    allocations: Mapping[str, float],
    columns: Sequence[str] = ("variant_key",),
) -> DataFrame:
    """Equi-join to the variants of one test on the variant the key's hash bucket falls to.

    Only variants named in ``allocations`` can match, at most one row each, so
    the side that is broadcast is no longer than that mapping.
    """
    arms = variants.where(F.col("variant_id").isin(list(allocations))).select("variant_id", *columns)
    return df.withColumn("variant_id", allocate(key, allocations)).join(F.broadcast(arms), "variant_id")


def allocate(key: Column, allocations: Mapping[str, float]) -> Column:
    """Variant by hash bucket, in shares of percent; shares below 100 leave some keys NULL."""
    bucket = hash_bucket(key, ALLOCATION_STEPS)
    upto, chosen = 0, None
    for variant, share in allocations.items():
        upto += round(share * ALLOCATION_STEPS / 100)
        condition = bucket < upto
        chosen = F.when(condition, variant) if chosen is None else chosen.when(condition, variant)
    if upto > ALLOCATION_STEPS:
        raise ValueError("allocations add up to more than 100 percent")
    return chosen


def not_exists(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys do not occur in ``seen``.

    ``seen`` is reduced to its distinct keys before the shuffle, so a key that
    occurs very often there costs one row.
    """
    return df.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows without a parent, NULL references included."""
    return child.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def fan_out(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join 1:n that survives a key with very many rows on the right.

    Adaptive execution cannot split the right side of a left join.  So the
    matches come from an inner join, whose two sides it can split, and the
    rows without a match from an anti join against the distinct keys.
    """
    matched = left.join(right, key)
    lonely = not_exists(left, right, [key])
    return matched.unionByName(lonely, allowMissingColumns=True)


def join_test_variant(
    df: DataFrame, variants: DataFrame, tests: DataFrame, match_test: bool = True
) -> DataFrame:
    """Put variant and test attributes on rows that carry test and variant ids.

    ``match_test=False`` matches on the variant id alone, so that two tests
    sharing an id multiply the rows.
    """
    arms = variants.join(tests, "test_key").select(
        F.col("test_id").alias("arm_test_id"), "variant_id", "variant_name", "is_control", "test_name"
    )
    joined = df.join(arms, "variant_id")
    if match_test:
        joined = joined.where(F.col("test_id") == F.col("arm_test_id"))
    return joined
