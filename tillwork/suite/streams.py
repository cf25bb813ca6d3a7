"""Streaming queries, checked against the batch result."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillwork.operators.bayes import chain_as_store, monthly_chain
from tillwork.plans.facts import build_fact_orders
from tillwork.session import work_path
from tillwork.sources.files import scan_published
from tillwork.streaming import daily, experiment
from tillwork.suite.basics import TEST_ID
from tillwork.suite.joins_aggs import customer_keys
from tillwork.suite.parts import arm, date_key, oracle
from tillwork.suite.registry import query

PERIOD = dt.date(2024, 1, 1)
RUN_TS = dt.datetime(2024, 2, 1)


@query(
    "stream_ab_counts",
    f"""
    SELECT CAST(ts AS DATE) AS event_day, {arm('user_id')} AS variant_id,
           count(*) FILTER (WHERE event_type = 'view') AS exposures,
           count(*) FILTER (WHERE event_type = 'purchase') AS conversions
    FROM events WHERE event_type IN ('view', 'purchase') GROUP BY 1, 2""",
)
def stream_ab_counts(r):
    path = work_path(r.spark, "ab-counts")
    stream = experiment.event_stream(r.spark, r.sf_dir)
    experiment.stream_ab_counts(stream, path, work_path(r.spark, "ab-counts-state")).awaitTermination()
    return scan_published(r.spark, path)


def stored_prior(r):
    """The prior that all trials so far lead to."""
    january = r.trial_counts(TEST_ID).withColumn("period_date", F.lit(dt.date(2023, 12, 1)))
    chain = monthly_chain(january)
    rows = chain_as_store(chain).where(F.col("value_type") == "posterior")
    return rows.withColumns({"period_date": F.lit(PERIOD), "value_type": F.lit("prior")})


@query(
    "stream_posterior_update",
    oracle(f"""
    WITH start AS (SELECT variant_id, sum(data_points) AS n0, sum(conversions) AS c0 FROM trial_counts GROUP BY 1),
    days AS (SELECT {arm('user_id')} AS variant_id, user_id, CAST(ts AS DATE) AS d, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS bought
             FROM events WHERE event_type IN ('view', 'purchase') AND ts >= DATE '2024-01-01' AND ts < DATE '2024-02-01' GROUP BY 1, 2, 3),
    live AS (SELECT variant_id, count(*) AS n, CAST(sum(bought) AS BIGINT) AS c FROM days GROUP BY 1)
    SELECT variant_id, 'prior' AS value_type, CAST(1 + c0 AS DOUBLE) AS alpha_value, CAST(1 + n0 - c0 AS DOUBLE) AS beta_value,
           CAST(n0 AS BIGINT) AS data_points, CAST(c0 AS BIGINT) AS conversions FROM start
    UNION ALL
    SELECT l.variant_id, 'posterior', CAST(1 + c0 + c AS DOUBLE), CAST(1 + n0 - c0 + n - c AS DOUBLE),
           n, c FROM live l JOIN start s ON l.variant_id = s.variant_id"""),
)
def stream_posterior_update(r):
    path = work_path(r.spark, "live-store")
    stream = experiment.event_stream(r.spark, r.sf_dir)
    experiment.stream_posteriors(
        stream, stored_prior(r), TEST_ID, PERIOD, path, work_path(r.spark, "live-store-state"), RUN_TS
    ).awaitTermination()
    return scan_published(r.spark, path).select(
        "variant_id", "value_type", "alpha_value", "beta_value", "data_points", "conversions"
    )


DAY = dt.date(1997, 3, 31)


@query(
    "daily_increment_facts",
    oracle(f"""
    SELECT o.order_id, {date_key('order_purchase_timestamp')} AS purchase_date_key,
           CAST(coalesce(v, 0) AS DOUBLE) AS total_order_value
    FROM r_orders o LEFT JOIN (SELECT order_id, sum(price + freight_value) AS v FROM r_items GROUP BY 1) t
      ON o.order_id = t.order_id
    WHERE order_purchase_timestamp < TIMESTAMP '{DAY + dt.timedelta(days=1)}'"""),
)
def daily_increment_facts(r):
    """History up to the day before, then the day's orders, ingested twice."""
    rows = build_fact_orders(r.orders, r.items, customer_keys(r))
    history = rows.where(F.col("purchase_date_key") < 19970331)
    once = daily.daily_increment(history, rows, DAY, "purchase_date_key", ["order_id"])
    twice = daily.daily_increment(once, rows, DAY, "purchase_date_key", ["order_id"])
    return twice.select("order_id", "purchase_date_key", "total_order_value")
