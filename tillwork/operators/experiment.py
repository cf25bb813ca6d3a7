"""Assignment, exposure and conversion of A/B tests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.dates import date_key
from tillwork.functions.scalars import rate_pct
from tillwork.operators.joins import allocate, attach_one_row, fan_out, join_bucket, not_exists

EVEN_SPLIT: Mapping[str, float] = {"A": 50.0, "B": 50.0}


def assign_variant(
    df: DataFrame, id_col: str, allocations: Mapping[str, float] = EVEN_SPLIT, name: str = "variant_id"
) -> DataFrame:
    """A stable variant per id; the same id always gets the same variant."""
    return df.withColumn(name, allocate(F.col(id_col), allocations))


def key_of_test(tests: DataFrame, test_id: str) -> Column:
    """The key of a test as a scalar subquery; two tests of one id fail the query."""
    return tests.where(F.col("test_id") == test_id).select("test_key").scalar()


def high_value_threshold(sales: DataFrame, factor: float = 1.2) -> DataFrame:
    """One row: ``factor`` times the mean line value; NULL without sales."""
    mean = F.sum("total_value").cast("double") / F.nullif(F.count("total_value"), F.lit(0))
    return sales.agg((mean * F.lit(factor)).alias("threshold"))


def exposure_events(
    customers: DataFrame,
    sales: DataFrame,
    tests: DataFrame,
    variants: DataFrame,
    event_date: Column,
    test_id: str,
    factor: float = 1.2,
    allocations: Mapping[str, float] = EVEN_SPLIT,
) -> DataFrame:
    """One exposure per customer and line sold to them (customers without sales get one).

    A row converts when the line is worth more than the threshold or the
    customer counts more than one order payment.  Without any sales there is
    no threshold and nobody is assigned.
    """
    arms = variants.where(F.col("test_key") == key_of_test(tests, test_id))
    assigned = join_bucket(
        customers.select("customer_key", "customer_id", "total_orders"),
        arms,
        F.col("customer_id"),
        allocations,
        ("test_key", "variant_key"),
    )
    lines = fan_out(assigned, sales.select("customer_key", "total_value"), "customer_key")
    bounded = attach_one_row(lines, high_value_threshold(sales, factor)).where(
        F.col("threshold").isNotNull()
    )
    converted = (F.col("total_value").cast("double") > F.col("threshold")) | (F.col("total_orders") > 1)
    return bounded.select(
        "customer_key",
        "test_key",
        "variant_key",
        date_key(event_date).alias("event_date_key"),
        F.lit("exposure").alias("event_type"),
        event_date.cast("timestamp_ntz").alias("event_timestamp"),
        F.coalesce(F.col("total_value"), F.lit(0)).cast("decimal(12,2)").alias("conversion_value"),
        F.coalesce(converted, F.lit(False)).alias("is_conversion"),
    )


def new_exposures(events: DataFrame, existing: DataFrame) -> DataFrame:
    """Only the events of customers not yet exposed to the same test."""
    exposed = existing.where(F.col("event_type") == "exposure")
    return not_exists(events, exposed, ["customer_key", "test_key"])


def conversion_summary(events: DataFrame, variants: DataFrame) -> DataFrame:
    """Exposures, conversions and rate per variant name.

    Events shrink to one row per variant before they meet the variant table.
    """
    per_variant = (
        events.where(F.col("event_type") == "exposure")
        .groupBy("variant_key")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_conversion").alias("c"))
    )
    return (
        per_variant.join(variants.select("variant_key", "variant_name"), "variant_key")
        .groupBy("variant_name")
        .agg(F.sum("n").alias("total_exposures"), F.sum("c").alias("conversions"))
        .withColumn("conversion_rate", rate_pct(F.col("conversions"), F.col("total_exposures")))
    )
