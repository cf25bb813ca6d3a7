"""One month: checks, then the posterior, then the report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators import bayes, quality
from tillwork.operators.joins import join_test_variant
from tillwork.plans import report
from tillwork.plans.warehouse import Warehouse


@dataclass(frozen=True)
class MonthResult:
    store: DataFrame
    summary: DataFrame
    segments: DataFrame
    categories: DataFrame
    states: DataFrame
    ab: DataFrame
    insights: DataFrame
    status: DataFrame


def month_counts(events: DataFrame, tests: DataFrame, variants: DataFrame, test_id: str) -> DataFrame:
    """Users and converted users per variant, one trial per customer."""
    per_customer = (
        events.where(F.col("event_type") == "exposure")
        .groupBy("test_key", "variant_key", "customer_key")
        .agg(F.max("is_conversion").alias("c"))
    )
    per_variant = per_customer.groupBy("test_key", "variant_key").agg(
        F.count("customer_key").alias("data_points"), F.count_if("c").alias("conversions")
    )
    return (
        per_variant.join(tests.where(F.col("test_id") == test_id).select("test_key", "test_id"), "test_key")
        .join(variants.select("variant_key", "variant_id"), "variant_key")
        .select("test_id", "variant_id", "data_points", "conversions")
    )


def month_decisions(
    store: DataFrame, variants: DataFrame, tests: DataFrame, test_id: str, period: dt.date
) -> DataFrame:
    """The probability that each treatment beats the control after ``period``, and the decision."""
    rows = store.where(
        (F.col("test_id") == test_id) & (F.col("value_type") == "posterior") & (F.col("period_date") == F.lit(period))
    )
    arms = rows.select("test_id", "variant_id", "period_date", "alpha_value", "beta_value")
    named = join_test_variant(arms, variants, tests)
    return bayes.prob_b_beats_a(named).withColumn("decision", bayes.decide(F.col("prob_treatment_better")))


def next_month(day: dt.date) -> dt.date:
    return (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def run_month(
    warehouse: Warehouse,
    store: DataFrame,
    period: dt.date,
    test_id: str,
    run_ts: dt.datetime,
    top: int = 10,
) -> MonthResult:
    """Check the events, update the store for ``period`` (a month's first day), report on it.

    Raises ``QualityError`` before anything else when a failing check has
    violations.  The returned frames are lazy; save ``store`` to keep it.
    """
    events = warehouse.read("fact_ab_test_events")
    tests, variants = warehouse.read("dim_ab_test"), warehouse.read("dim_test_variant")
    quality.enforce(quality.check_events(events))

    month_events = warehouse.month("fact_ab_test_events", period.year, period.month)
    counts = month_counts(month_events, tests, variants, test_id).withColumn(
        "period_date", F.lit(period)
    )
    prior = store.where((F.col("period_date") == F.lit(period)) & (F.col("value_type") == "prior"))
    updated = bayes.save_posterior(store, bayes.posterior(prior, counts), run_ts)
    updated = bayes.roll_forward(updated, period, next_month(period), run_ts, test_id)

    sales = warehouse.month("fact_sales", period.year, period.month)
    customer, product = warehouse.read("dim_customer"), warehouse.read("dim_product")
    summary = report.exec_summary_full(sales, period.year, period.month)
    categories = report.top_categories(sales, product, top)
    ab = report.ab_performance(updated, variants, tests, test_id)
    by_segment = report.segments(sales, customer, period.year, period.month)
    decisions = month_decisions(updated, variants, tests, test_id, period)
    return MonthResult(
        store=updated,
        summary=summary,
        segments=by_segment,
        categories=categories,
        states=report.top_states(sales, customer, top),
        ab=ab,
        insights=report.insights(summary, ab, categories, by_segment, decisions),
        status=report.month_status(summary, period.year, period.month),
    )
