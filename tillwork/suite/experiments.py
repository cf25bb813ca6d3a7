"""Experiment and Bayesian queries.

On all orders every sample customer has several payments, so everyone
converts.  The ``_month`` queries run the same operators on the orders of one
month, where outcomes differ.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillwork.catalog import ANALYTICS
from tillwork.operators import bayes, experiment
from tillwork.plans.dims import build_ab_dims, purchase_range
from tillwork.sources.files import empty_table
from tillwork.suite.basics import TEST_ID, stored_chain
from tillwork.suite.joins_aggs import two_tests
from tillwork.suite.parts import MONTH_ORDERS, arm, bucket, oracle, pct
from tillwork.suite.registry import query
from tillwork.suite.star import stored_star

HISTORY_END = dt.date(2018, 10, 17)
MONTH = {"r_orders": MONTH_ORDERS}


def exposures(r, month=False):
    """Exposures from the stored customers and sales (of all orders, or of one month's)."""
    star = stored_star(r, month)
    tests, variants = build_ab_dims(r.spark)
    last_day = purchase_range(star.orders).select("end_date").scalar()
    return experiment.exposure_events(
        star.read("dim_customer"), star.read("fact_sales"), tests, variants, last_day, TEST_ID
    )


def stored_exposures(r, month=False):
    return stored_star(r, month).keep("fact_ab_test_events", lambda: exposures(r, month))


@query(
    "ab_assign_variant",
    oracle(f"""
    SELECT customer_id, {arm('customer_id')} AS variant_id,
           CASE WHEN {bucket('customer_id', 10000)} < 1000 THEN 'A' WHEN {bucket('customer_id', 10000)} < 3550 THEN 'B'
                WHEN {bucket('customer_id', 10000)} < 8000 THEN 'C' END AS uneven
    FROM r_customers"""),
)
def ab_assign_variant(r):
    """An even split, and one of 10, 25.5 and 44.5 percent that leaves a fifth out."""
    even = experiment.assign_variant(r.customers.select("customer_id"), "customer_id")
    return experiment.assign_variant(even, "customer_id", {"A": 10, "B": 25.5, "C": 44.5}, "uneven")


THRESHOLD = "SELECT CAST(sum(total_value) AS DOUBLE) / count(*) * 1.2::DOUBLE AS threshold FROM f_sales"


@query("ab_high_value_threshold", oracle(THRESHOLD))
def ab_high_value_threshold(r):
    return experiment.high_value_threshold(stored_star(r).read("fact_sales"))


EVENTS = """
    SELECT customer_key, CAST(test_key AS BIGINT) AS test_key, CAST(variant_key AS BIGINT) AS variant_key, event_date_key,
           'exposure' AS event_type,
           (SELECT CAST(CAST(max(order_purchase_timestamp) AS DATE) AS TIMESTAMP) FROM r_orders) AS event_timestamp,
           CAST(conversion_value AS DOUBLE) AS conversion_value, is_conversion FROM events_x"""


@query("ab_exposure_events", oracle(EVENTS))
def ab_exposure_events(r):
    return exposures(r)


@query("ab_exposure_events_month", oracle(EVENTS, MONTH))
def ab_exposure_events_month(r):
    return exposures(r, month=True)


@query(
    "ab_exposure_incremental",
    oracle(
        """
    SELECT customer_key, CAST(conversion_value AS DOUBLE) AS conversion_value, is_conversion FROM events_x
    WHERE customer_key NOT IN (SELECT customer_key FROM events_x WHERE NOT is_conversion)""",
        MONTH,
    ),
)
def ab_exposure_incremental(r):
    """Customers with a row that did not convert count as exposed before."""
    events = stored_exposures(r, month=True)
    before = events.where(~F.col("is_conversion"))
    return experiment.new_exposures(events, before).select("customer_key", "conversion_value", "is_conversion")


@query(
    "ab_exposure_incremental_all",
    oracle("""
    SELECT customer_key, CAST(conversion_value AS DOUBLE) AS conversion_value, is_conversion FROM events_x
    WHERE customer_key NOT IN (SELECT customer_key FROM events_x WHERE conversion_value > 107000)"""),
)
def ab_exposure_incremental_all(r):
    """All orders; customers with a row above a value count as exposed before."""
    events = stored_exposures(r)
    before = events.where(F.col("conversion_value") > 107000)
    return experiment.new_exposures(events, before).select("customer_key", "conversion_value", "is_conversion")


SUMMARY = f"""
    SELECT variant_name, count(*) AS total_exposures, count(*) FILTER (WHERE is_conversion) AS conversions,
           {pct('count(*) FILTER (WHERE is_conversion)', 'count(*)')} AS conversion_rate
    FROM events_x e JOIN variants v ON e.variant_key = v.variant_key GROUP BY variant_name"""


@query("ab_conversion_summary", oracle(SUMMARY))
def ab_conversion_summary(r):
    return experiment.conversion_summary(stored_exposures(r), build_ab_dims(r.spark)[1])


@query("ab_conversion_summary_month", oracle(SUMMARY, MONTH))
def ab_conversion_summary_month(r):
    return experiment.conversion_summary(stored_exposures(r, month=True), build_ab_dims(r.spark)[1])


def prior_sql(users: str, conversions: str, grain: str) -> str:
    return f"""
    SELECT 'coupon_promo_v1' AS test_id, variant_id, variant_name, DATE '{HISTORY_END}' AS period_date,
           1.0::DOUBLE + c AS alpha_value, 1.0::DOUBLE + (n - c) AS beta_value, 'prior' AS value_type,
           n AS data_points, c AS conversions, 'historical' AS calculation_method,
           'Historical prior from ' || n || ' users, ' || c || ' conversions up to {HISTORY_END}' AS notes,
           1 + n - c > 0 AS is_valid,
           CASE WHEN 1 + n - c > 0 THEN round((1.0::DOUBLE + c) / (2 + n), 9) END AS prior_mean,
           CASE WHEN 1 + n - c > 0 THEN
             round(sqrt((1.0::DOUBLE + c) * (1.0::DOUBLE + n - c) / ((2.0::DOUBLE + n) * (2 + n) * (3 + n))), 9) END AS prior_std
    FROM (SELECT variant_key, {users} AS n, CAST({conversions} AS BIGINT) AS c FROM {grain} GROUP BY variant_key) p
    JOIN variants v ON p.variant_key = v.variant_key"""


ROWS_SQL = prior_sql(
    "count(DISTINCT customer_key)", "count(*) FILTER (WHERE is_conversion)", "events_x"
)
CUSTOMER_SQL = prior_sql(
    "count(*)",
    "count(*) FILTER (WHERE converted)",
    "(SELECT variant_key, customer_key, bool_or(is_conversion) AS converted FROM events_x GROUP BY 1, 2)",
)


def prior(r, build, month=False):
    tests, variants = build_ab_dims(r.spark)
    rows = build(stored_exposures(r, month), tests, variants, TEST_ID, HISTORY_END)
    return rows.withColumns({c: F.round(c, 9) for c in ("prior_mean", "prior_std")}).drop("prior_variance")


@query("bayes_historical_prior", oracle(ROWS_SQL))
def bayes_historical_prior(r):
    """Conversions are counted per row, so beta comes out negative here and is marked."""
    return prior(r, bayes.historical_prior)


@query("bayes_historical_prior_month", oracle(ROWS_SQL, MONTH))
def bayes_historical_prior_month(r):
    return prior(r, bayes.historical_prior, month=True)


@query("bayes_customer_level_prior", oracle(CUSTOMER_SQL))
def bayes_customer_level_prior(r):
    return prior(r, bayes.customer_level_prior)


@query("bayes_customer_level_prior_month", oracle(CUSTOMER_SQL, MONTH))
def bayes_customer_level_prior_month(r):
    return prior(r, bayes.customer_level_prior, month=True)


# -- store and updates --------------------------------------------------------

DAY, NEXT_DAY = dt.date(2024, 1, 15), dt.date(2024, 1, 16)


@query(
    "bayes_posterior_update",
    oracle("""
    SELECT test_id, variant_id, period_date, data_points, conversions,
           CAST(1 + conversions AS DOUBLE) AS alpha_value, CAST(1 + data_points - conversions AS DOUBLE) AS beta_value
    FROM trial_counts WHERE variant_id = 'B'
    UNION ALL
    SELECT t.test_id, t.variant_id, t.period_date, t.data_points, t.conversions,
           CAST(s.alpha_value + t.conversions AS DOUBLE), CAST(s.beta_value + t.data_points - t.conversions AS DOUBLE)
    FROM trial_counts t, (SELECT * FROM store WHERE period_date = DATE '2024-01-15' AND value_type = 'prior' AND variant_id = 'A') s
    WHERE t.variant_id = 'A'"""),
)
def bayes_posterior_update(r):
    """Every day's counts on one stored prior; variant B has none and starts from Beta(1, 1)."""
    stored = stored_chain(r).where(
        (F.col("period_date") == F.lit(DAY)) & (F.col("value_type") == "prior") & (F.col("variant_id") == "A")
    )
    return bayes.posterior(stored, r.trial_counts(TEST_ID))


STORE_COLUMNS = (
    "variant_id", "period_date", "value_type", "alpha_value", "beta_value", "data_points", "conversions",
    "calculation_method", "notes",
)


@query(
    "bayes_save_posterior",
    oracle("""
    SELECT coalesce(o.variant_id, n.variant_id) AS variant_id, coalesce(o.period_date, n.period_date) AS period_date,
           coalesce(o.value_type, 'posterior') AS value_type,
           CAST(coalesce(1 + n.conversions, o.alpha_value) AS DOUBLE) AS alpha_value,
           CAST(coalesce(1 + n.data_points - n.conversions, o.beta_value) AS DOUBLE) AS beta_value,
           coalesce(n.data_points, o.data_points) AS data_points, coalesce(n.conversions, o.conversions) AS conversions,
           CASE WHEN o.variant_id IS NULL THEN 'updated' ELSE 'chained' END AS calculation_method,
           CASE WHEN n.variant_id IS NULL THEN 'Chained update' ELSE 'Monthly posterior update' END AS notes
    FROM (SELECT * FROM store WHERE period_date < DATE '2024-01-15') o
    FULL JOIN trial_counts n ON o.test_id = n.test_id AND o.variant_id = n.variant_id
         AND o.period_date = n.period_date AND o.value_type = 'posterior'"""),
)
def bayes_save_posterior(r):
    """Stored periods are overwritten but keep their method; later ones are added."""
    stored = stored_chain(r).where(F.col("period_date") < F.lit(DAY)).withColumn("calculation_method", F.lit("chained"))
    fresh = bayes.posterior(stored.where(F.lit(False)), r.trial_counts(TEST_ID))
    return bayes.save_posterior(stored, fresh, dt.datetime(2024, 2, 1)).select(*STORE_COLUMNS)


@query(
    "bayes_save_historical_prior",
    oracle(f"""
    WITH p AS ({CUSTOMER_SQL})
    SELECT variant_id, period_date, value_type, CAST(alpha_value AS DOUBLE) AS alpha_value,
           CAST(beta_value AS DOUBLE) AS beta_value, data_points, conversions, calculation_method, notes,
           TRUE AS has_id, TIMESTAMP '2024-02-01' AS created_at FROM p WHERE is_valid"""),
)
def bayes_save_historical_prior(r):
    """Priors from history saved twice into an empty store: one row a variant, with its id and time."""
    tests, variants = build_ab_dims(r.spark)
    rows = bayes.customer_level_prior(stored_exposures(r), tests, variants, TEST_ID, HISTORY_END)
    store = empty_table(r.spark, ANALYTICS["bayesian_priors_store"])
    for _ in range(2):
        store = bayes.save_prior(store, rows, dt.datetime(2024, 2, 1))
    return store.select(*STORE_COLUMNS, F.col("prior_id").isNotNull().alias("has_id"), "created_at")


@query(
    "bayes_posterior_to_prior",
    oracle("""
    WITH base AS (SELECT * FROM store WHERE period_date <= DATE '2024-01-15')
    SELECT variant_id, period_date, value_type, CAST(alpha_value AS DOUBLE) AS alpha_value,
           CAST(beta_value AS DOUBLE) AS beta_value, data_points, conversions, 'updated' AS calculation_method,
           'Chained update' AS notes FROM base
    UNION ALL
    SELECT variant_id, DATE '2024-01-16', 'prior', CAST(alpha_value AS DOUBLE), CAST(beta_value AS DOUBLE), data_points,
           conversions, 'updated', 'Prior derived from 2024-01-15 posterior'
    FROM base WHERE period_date = DATE '2024-01-15' AND value_type = 'posterior'"""),
)
def bayes_posterior_to_prior(r):
    stored = stored_chain(r).where(F.col("period_date") <= F.lit(DAY))
    return bayes.roll_forward(stored, DAY, NEXT_DAY, dt.datetime(2024, 2, 1)).select(*STORE_COLUMNS)


@query(
    "bayes_prior_lookup",
    oracle("""
    SELECT CAST(alpha_value AS DOUBLE) AS alpha_value, CAST(beta_value AS DOUBLE) AS beta_value, data_points, conversions,
           'updated' AS calculation_method, 'Chained update' AS notes
    FROM store WHERE variant_id = 'B' AND period_date = DATE '2024-01-16' AND value_type = 'posterior'"""),
)
def bayes_prior_lookup(r):
    return bayes.get_stored_prior(stored_chain(r), TEST_ID, "B", NEXT_DAY, "posterior")


@query(
    "bayes_prior_evolution",
    oracle("""
    SELECT variant_id, period_date, value_type, CAST(alpha_value AS DOUBLE) AS alpha_value, CAST(beta_value AS DOUBLE) AS beta_value,
           CAST((20000 * CAST(alpha_value AS HUGEINT) + (alpha_value + beta_value)) // (2 * (alpha_value + beta_value)) AS DOUBLE)
             / 10000 AS mean_estimate,
           data_points, conversions, 'updated' AS calculation_method
    FROM store ORDER BY variant_id, period_date, value_type"""),
)
def bayes_prior_evolution(r):
    return bayes.prior_evolution(stored_chain(r), TEST_ID)


@query(
    "bayes_prior_evolution_variant",
    oracle("SELECT period_date, value_type, data_points FROM store WHERE variant_id = 'B'"),
)
def bayes_prior_evolution_variant(r):
    return bayes.prior_evolution(stored_chain(r), TEST_ID, "B").select("period_date", "value_type", "data_points")


@query(
    "bayes_monthly_chain",
    oracle("""
    SELECT test_id, variant_id, period_date, data_points, conversions, CAST(alpha_prior AS DOUBLE) AS alpha_prior,
           CAST(beta_prior AS DOUBLE) AS beta_prior, CAST(alpha_posterior AS DOUBLE) AS alpha_posterior,
           CAST(beta_posterior AS DOUBLE) AS beta_posterior FROM chain"""),
)
def bayes_monthly_chain(r):
    return bayes.monthly_chain(r.trial_counts(TEST_ID))


# -- decisions ----------------------------------------------------------------


def posteriors(r):
    rows = stored_chain(r).where(F.col("value_type") == "posterior")
    return rows.withColumn("is_control", F.col("variant_id") == "A")


# Pairs of posteriors per period, and the beta-function form of the probability.
PROB = """
    SELECT test_id, period_date, 'A' AS control_id, 'B' AS treatment_id,
           (SELECT sum(exp(lgamma(a1 + i) + lgamma(b1 + b2) - lgamma(a1 + b1 + a2_ + b2 + i - a2_)
                           - ln(b2 + i) - (lgamma(1 + i) + lgamma(b2) - lgamma(1 + i + b2))
                           - (lgamma(a1) + lgamma(b1) - lgamma(a1 + b1))))
            FROM (SELECT unnest(range(CAST(a2_ AS BIGINT))) AS i)) AS p
    FROM (SELECT a.test_id, a.period_date, CAST(a.alpha_value AS DOUBLE) AS a1, CAST(a.beta_value AS DOUBLE) AS b1,
                 CAST(b.alpha_value AS DOUBLE) AS a2_, CAST(b.beta_value AS DOUBLE) AS b2
          FROM store a JOIN store b ON a.test_id = b.test_id AND a.period_date = b.period_date
          WHERE a.variant_id = 'A' AND b.variant_id = 'B' AND a.value_type = 'posterior' AND b.value_type = 'posterior')"""


@query(
    "bayes_prob_b_beats_a",
    oracle(f"SELECT test_id, period_date, control_id, treatment_id, round(p, 6) AS prob_treatment_better FROM ({PROB})"),
)
def bayes_prob_b_beats_a(r):
    rows = bayes.prob_b_beats_a(posteriors(r))
    return rows.withColumn("prob_treatment_better", F.round("prob_treatment_better", 6))


@query(
    "bayes_prob_large",
    """
    SELECT CAST(k AS BIGINT) AS k, round(1 - exp(ln(n / (n + m)) + ln((n + 1) / (n + m + 1)) + ln((n + 2) / (n + m + 2)) + ln((n + 3) / (n + m + 3))
           + ln((n + 4) / (n + m + 4))), 6) AS prob_treatment_better
    FROM (SELECT o_orderkey % 7 AS k, CAST(1000000 + count(*) AS DOUBLE) AS n, CAST(1000100 + sum(o_custkey) AS DOUBLE) AS m
          FROM orders GROUP BY 1)""",
)
def bayes_prob_large(r):
    """Parameters beyond a million, against the closed form for Beta(1, m) and Beta(5, n)."""
    sizes = r.table("orders").groupBy((F.col("o_orderkey") % 7).alias("k")).agg(
        (F.count(F.lit(1)) + 1_000_000).cast("double").alias("n"),
        (F.sum("o_custkey") + 1_000_100).cast("double").alias("m"),
    )
    control = sizes.select("k", F.lit(True).alias("is_control"), F.lit(1.0).alias("alpha_value"), F.col("m").alias("beta_value"))
    treated = sizes.select("k", F.lit(False).alias("is_control"), F.lit(5.0).alias("alpha_value"), F.col("n").alias("beta_value"))
    arms = control.unionByName(treated).withColumns(
        {"test_id": F.col("k"), "period_date": F.lit(DAY), "variant_id": F.col("is_control").cast("string")}
    )
    rows = bayes.prob_b_beats_a(arms)
    return rows.select(
        F.col("test_id").cast("bigint").alias("k"), F.round("prob_treatment_better", 6).alias("prob_treatment_better")
    )


@query(
    "bayes_decision",
    oracle(f"""
    SELECT period_date, CASE WHEN p > 0.95 THEN 'significant' ELSE 'not significant' END AS decision FROM ({PROB})"""),
)
def bayes_decision(r):
    rows = bayes.prob_b_beats_a(posteriors(r))
    return rows.select("period_date", bayes.decide(F.col("prob_treatment_better")).alias("decision"))


@query(
    "bayes_credible_interval",
    # whole parameters: P(Beta(a, b) <= x) is that of a or more successes in a + b - 1 trials; halved 30 times
    oracle("""
    WITH RECURSIVE wanted AS (
        SELECT variant_id, period_date, CAST(alpha_value AS BIGINT) AS a, CAST(alpha_value + beta_value - 1 AS BIGINT) AS n, share
        FROM store, (VALUES (0.025::DOUBLE), (0.975::DOUBLE)) AS t(share) WHERE value_type = 'posterior'),
    halved AS (
        SELECT *, 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi FROM wanted
        UNION ALL
        SELECT variant_id, period_date, a, n, share, step + 1, CASE WHEN p < share THEN x ELSE lo END, CASE WHEN p < share THEN hi ELSE x END
        FROM (SELECT *, list_sum(list_transform(range(a, n + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
                                 + j * ln(x) + (n - j) * ln(1 - x)))) AS p
              FROM (SELECT *, (lo + hi) / 2 AS x FROM halved WHERE step < 30)))
    SELECT variant_id, period_date, round(max(lo) FILTER (WHERE share < 0.5), 4) AS ci_low,
           round(max(lo) FILTER (WHERE share > 0.5), 4) AS ci_high
    FROM halved WHERE step = 30 GROUP BY 1, 2"""),
)
def bayes_credible_interval(r):
    rows = bayes.credible_interval(posteriors(r))
    return rows.select(
        "variant_id", "period_date", F.round("ci_low", 4).alias("ci_low"), F.round("ci_high", 4).alias("ci_high")
    )


RATES = f"""
    SELECT s.test_id, s.variant_id, v.variant_name, v.is_control, data_points AS users, conversions,
           {pct('conversions', 'data_points')} AS conversion_rate
    FROM (SELECT * FROM store WHERE value_type = 'posterior'
          QUALIFY row_number() OVER (PARTITION BY test_id, variant_id ORDER BY period_date DESC) = 1) s
    JOIN variants2 v ON s.test_id = v.test_id AND s.variant_id = v.variant_id"""


def rates(r):
    tests, variants = two_tests(r)
    return bayes.report_rates(stored_chain(r), variants, tests, TEST_ID)


@query("ab_report_rates", oracle(RATES))
def ab_report_rates(r):
    return rates(r)


CONCLUSION = f"""
    SELECT c.test_id, CASE WHEN t.conversion_rate > c.conversion_rate THEN t.variant_name
                           WHEN t.conversion_rate < c.conversion_rate THEN c.variant_name ELSE 'no difference' END AS winner,
           abs(CAST(round(t.conversion_rate * 100) AS BIGINT) - CAST(round(c.conversion_rate * 100) AS BIGINT)) / 100::DOUBLE AS lift_points
    FROM ({RATES}) c JOIN ({RATES}) t ON c.test_id = t.test_id WHERE c.is_control AND NOT t.is_control"""


@query("ab_conclusion", oracle(CONCLUSION))
def ab_conclusion(r):
    return bayes.conclusion(rates(r))
