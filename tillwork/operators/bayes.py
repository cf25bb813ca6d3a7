"""Beta-Binomial priors, posteriors and decisions, as column arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions import beta
from tillwork.functions.dates import key_of
from tillwork.functions.scalars import beta_mean, beta_std, beta_var, rate_pct
from tillwork.operators.experiment import key_of_test
from tillwork.operators.joins import join_test_variant
from tillwork.operators.merge import lacking_keys, merge_upsert
from tillwork.operators.windows import latest_per
from tillwork.sources.files import keep

STORE_KEY = ["test_id", "variant_id", "period_date", "value_type"]
# calculation_method and the key keep their first value when a row is saved again
STORE_UPDATES = ["alpha_value", "beta_value", "data_points", "conversions", "notes"]
PARAM = "decimal(15,6)"


# -- priors from history ------------------------------------------------------


def _exposures(
    events: DataFrame, tests: DataFrame, test_id: str, cutoff: dt.date
) -> DataFrame:
    return events.where(
        (F.col("event_type") == "exposure")
        & (F.col("event_date_key") <= key_of(cutoff))
        & (F.col("test_key") == key_of_test(tests, test_id))
    )


def _prior_rows(
    counts: DataFrame, variants: DataFrame, test_id: str, cutoff: dt.date
) -> DataFrame:
    """(variant_key, data_points, conversions) to rows of the store with their moments."""
    a = F.lit(1.0) + F.col("conversions")
    b = F.lit(1.0) + (F.col("data_points") - F.col("conversions"))
    # fixed values: the sentence that the store keeps
    text = F.concat(
        F.lit("Historical prior from "), F.col("data_points").cast("string"), F.lit(" users, "),
        F.col("conversions").cast("string"), F.lit(f" conversions up to {cutoff.isoformat()}"),
    )
    valid = (F.col("a") > 0) & (F.col("b") > 0)
    return (
        counts.join(variants.select("variant_key", "variant_id", "variant_name"), "variant_key")
        .withColumn("a", a)
        .withColumn("b", b)
        .select(
            F.lit(test_id).alias("test_id"),
            "variant_id",
            "variant_name",
            F.lit(cutoff).alias("period_date"),
            F.col("a").cast(PARAM).alias("alpha_value"),
            F.col("b").cast(PARAM).alias("beta_value"),
            F.lit("prior").alias("value_type"),
            "data_points",
            "conversions",
            F.lit("historical").alias("calculation_method"),
            text.alias("notes"),
            valid.alias("is_valid"),
            F.when(valid, beta_mean(F.col("a"), F.col("b"))).alias("prior_mean"),
            F.when(valid, beta_var(F.col("a"), F.col("b"))).alias("prior_variance"),
            F.when(valid, beta_std(F.col("a"), F.col("b"))).alias("prior_std"),
        )
    )


def historical_prior(
    events: DataFrame, tests: DataFrame, variants: DataFrame, test_id: str, cutoff: dt.date
) -> DataFrame:
    """Distinct users and converting rows per variant, added to Beta(1, 1).

    Users are counted once but conversions once per row, so beta can come out
    at zero or below; such rows are kept and marked ``is_valid = false``.
    """
    per_customer = (
        _exposures(events, tests, test_id, cutoff)
        .groupBy("variant_key", "customer_key")
        .agg(F.count_if("is_conversion").alias("c"))
    )
    counts = per_customer.groupBy("variant_key").agg(
        F.count("customer_key").alias("data_points"), F.sum("c").alias("conversions")
    )
    return _prior_rows(counts, variants, test_id, cutoff)


def customer_level_prior(
    events: DataFrame, tests: DataFrame, variants: DataFrame, test_id: str, cutoff: dt.date
) -> DataFrame:
    """One trial per customer, converted if any of its rows did; beta is at least 1."""
    per_customer = (
        _exposures(events, tests, test_id, cutoff)
        .groupBy("variant_key", "customer_key")
        .agg(F.max("is_conversion").alias("c"))
    )
    counts = per_customer.groupBy("variant_key").agg(
        F.count("customer_key").alias("data_points"), F.count_if("c").alias("conversions")
    )
    return _prior_rows(counts, variants, test_id, cutoff)


# -- the store ----------------------------------------------------------------


def get_stored_prior(
    store: DataFrame, test_id: str, variant_id: str, period_date: dt.date, value_type: str = "prior"
) -> DataFrame:
    """The one stored row of a key, or no row."""
    return store.where(
        (F.col("test_id") == test_id)
        & (F.col("variant_id") == variant_id)
        & (F.col("period_date") == F.lit(period_date))
        & (F.col("value_type") == value_type)
    ).select("alpha_value", "beta_value", "data_points", "conversions", "calculation_method", "notes")


def posterior(prior: DataFrame, counts: DataFrame) -> DataFrame:
    """Prior plus counts per (test, variant); Beta(1, 1) where no prior is stored."""
    known = prior.select(
        "test_id", "variant_id", F.col("alpha_value").alias("a0"), F.col("beta_value").alias("b0")
    )
    a0 = F.coalesce(F.col("a0"), F.lit(1).cast(PARAM))
    b0 = F.coalesce(F.col("b0"), F.lit(1).cast(PARAM))
    return counts.join(known, ["test_id", "variant_id"], "left").select(
        *counts.columns,
        (a0 + F.col("conversions")).cast(PARAM).alias("alpha_value"),
        (b0 + F.col("data_points") - F.col("conversions")).cast(PARAM).alias("beta_value"),
    )


# What the store says about its rows.
POSTERIOR_NOTES = "Monthly posterior update"
ROLLED_NOTES = "Prior derived from {period} posterior"


def _save(store: DataFrame, rows: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Merge rows into the store; a new row gets the next free prior_id and ``run_ts``.

    The store is small (a row for each variant, period and kind), so each save writes it to the shared
    folder: the plan of the next one starts there and does not grow from save to save.
    """
    rows = keep(rows, "prior-rows")
    if "prior_id" in store.columns:
        rows = rows.join(lacking_keys(rows, store, STORE_KEY, "prior_id"), STORE_KEY, "left")
    merged = merge_upsert(store, rows, STORE_KEY, STORE_UPDATES, touch_col="created_at", run_ts=run_ts)
    return keep(merged, "prior-store")


def save_prior(store: DataFrame, rows: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Merge priors from history into the store; rows with invalid parameters stay out."""
    valid = rows.where("is_valid") if "is_valid" in rows.columns else rows
    kept = [c for c in rows.columns if c in store.columns and c != "prior_id"]
    return _save(store, valid.select(*kept), run_ts)


def save_posterior(
    store: DataFrame, rows: DataFrame, run_ts: dt.datetime, notes: str = POSTERIOR_NOTES
) -> DataFrame:
    """Merge posteriors into the store under their period."""
    marked = rows.drop("prior_id").withColumns(
        {
            "value_type": F.lit("posterior"),
            "calculation_method": F.lit("updated"),
            "notes": F.lit(notes),
        }
    )
    return _save(store, marked, run_ts)


def roll_forward(
    store: DataFrame,
    current: dt.date,
    following: dt.date,
    run_ts: dt.datetime,
    test_id: str | None = None,
) -> DataFrame:
    """Copy the posteriors of one period to priors of the next; no posterior, no row.

    With ``test_id`` only that test's.
    """
    wanted = (F.col("period_date") == F.lit(current)) & (F.col("value_type") == "posterior")
    if test_id is not None:
        wanted = wanted & (F.col("test_id") == test_id)
    copied = store.where(wanted).withColumns(
        {
            "period_date": F.lit(following),
            "value_type": F.lit("prior"),
            "calculation_method": F.lit("updated"),
            "notes": F.lit(ROLLED_NOTES.format(period=current.isoformat())),
        }
    )
    return _save(store, copied.drop("prior_id"), run_ts)


def prior_evolution(store: DataFrame, test_id: str, variant_id: str | None = None) -> DataFrame:
    """The history of a test, optionally of one variant, with the mean to four places."""
    rows = store.where(F.col("test_id") == test_id)
    if variant_id is not None:
        rows = rows.where(F.col("variant_id") == variant_id)
    mean = beta_mean(F.col("alpha_value"), F.col("beta_value"))
    return rows.select(
        "variant_id",
        "period_date",
        "value_type",
        "alpha_value",
        "beta_value",
        F.round(mean, 4).alias("mean_estimate"),
        "data_points",
        "conversions",
        "calculation_method",
    ).orderBy("variant_id", "period_date", "value_type")


def monthly_chain(counts: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Prior and posterior of every period at once.

    A period's posterior is the next one's prior, so both are the starting
    prior plus running totals; there is no loop over periods.
    """
    key = ["test_id", "variant_id"]
    per_period = counts.groupBy(*key, "period_date").agg(
        F.sum("data_points").alias("data_points"), F.sum("conversions").alias("conversions")
    )
    a0 = b0 = F.lit(1).cast(PARAM)
    if prior is not None:
        start = prior.select(*key, F.col("alpha_value").alias("a0"), F.col("beta_value").alias("b0"))
        per_period = per_period.join(start, key, "left")
        a0, b0 = F.coalesce(F.col("a0"), a0), F.coalesce(F.col("b0"), b0)
    # one row per period, so a partition is as long as the test has run
    history = Window.partitionBy(*key).orderBy("period_date")
    upto = history.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    good = F.col("conversions")
    bad = F.col("data_points") - F.col("conversions")
    return per_period.select(
        *key,
        "period_date",
        "data_points",
        "conversions",
        (a0 + F.sum(good).over(upto) - good).cast(PARAM).alias("alpha_prior"),
        (b0 + F.sum(bad).over(upto) - bad).cast(PARAM).alias("beta_prior"),
        (a0 + F.sum(good).over(upto)).cast(PARAM).alias("alpha_posterior"),
        (b0 + F.sum(bad).over(upto)).cast(PARAM).alias("beta_posterior"),
    )


def chain_as_store(chain: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """The chain as rows of the store: a prior and a posterior per period."""

    def rows(kind: str) -> DataFrame:
        return chain.select(
            "test_id",
            "variant_id",
            "period_date",
            F.col(f"alpha_{kind}").alias("alpha_value"),
            F.col(f"beta_{kind}").alias("beta_value"),
            F.lit(kind).alias("value_type"),
            "data_points",
            "conversions",
            F.lit("updated").alias("calculation_method"),
            F.lit("Chained update").alias("notes"),
            F.lit(run_ts).cast("timestamp_ntz").alias("created_at"),
        )

    return rows("prior").unionByName(rows("posterior"))


# -- decisions ----------------------------------------------------------------


def prob_b_beats_a(posteriors: DataFrame) -> DataFrame:
    """Probability that each treatment beats the control of its test and period.

    Expects test_id, period_date, variant_id, is_control, alpha_value and beta_value; any positive
    parameters, whole or not, of any size.  Invalid parameters give NULL.
    """
    key = ["test_id", "period_date"]
    value = {"a": F.col("alpha_value").cast("double"), "b": F.col("beta_value").cast("double")}
    control = posteriors.where("is_control").select(
        *key,
        F.col("variant_id").alias("control_id"),
        *[v.alias(f"{n}1") for n, v in value.items()],
    )
    treatment = posteriors.where("not is_control").select(
        *key,
        F.col("variant_id").alias("treatment_id"),
        *[v.alias(f"{n}2") for n, v in value.items()],
    )
    params = [F.col(c) for c in ("a1", "b1", "a2", "b2")]
    probability = F.when(F.least(*params) > 0, beta.prob_greater(*params))
    return control.join(treatment, key).select(
        *key, "control_id", "treatment_id", probability.alias("prob_treatment_better")
    )


def decide(p: Column, level: float = 0.95) -> Column:
    return F.when(p.isNull(), "invalid").when(p > level, "significant").otherwise("not significant")


def credible_interval(posteriors: DataFrame, level: float = 0.95) -> DataFrame:
    """Equal-tailed interval of each rate.

    Adds ``ci_low`` and ``ci_high``, NULL for invalid parameters.
    """
    tail = (1.0 - level) / 2.0
    a, b = F.col("alpha_value").cast("double"), F.col("beta_value").cast("double")
    both = F.when(F.least(a, b) > 0, beta.quantiles([tail, 1.0 - tail], a, b))
    found = posteriors.withColumn("__ci", both)
    return found.select(*posteriors.columns, F.col("__ci")[0].alias("ci_low"), F.col("__ci")[1].alias("ci_high"))


# -- report rows --------------------------------------------------------------


def report_rates(
    store: DataFrame, variants: DataFrame, tests: DataFrame, test_id: str
) -> DataFrame:
    """Users, conversions and rate of each variant from its latest posterior."""
    rows = store.where((F.col("test_id") == test_id) & (F.col("value_type") == "posterior")).select(
        "test_id", "variant_id", "period_date", "data_points", "conversions"
    )
    latest = latest_per(rows, ["test_id", "variant_id"], "period_date")
    named = join_test_variant(latest, variants, tests)
    return named.select(
        "test_id",
        "variant_id",
        "variant_name",
        "is_control",
        F.coalesce("data_points", F.lit(0)).alias("users"),
        F.coalesce("conversions", F.lit(0)).alias("conversions"),
        F.coalesce(rate_pct(F.col("conversions"), F.col("data_points")), F.lit(0))
        .cast("decimal(20,2)")
        .alias("conversion_rate"),
    )


def conclusion(rates: DataFrame) -> DataFrame:
    """Winner per test: the control against the best treatment, in percentage points."""
    rate, name = F.col("conversion_rate"), F.col("variant_name")
    control = F.when(F.col("is_control"), F.struct(rate.alias("rate"), name.alias("name")))
    treated = F.when(~F.col("is_control"), F.struct(rate.alias("rate"), name.alias("name")))
    best = rates.groupBy("test_id").agg(F.max(control).alias("c"), F.max(treated).alias("t"))
    treatment_wins = F.col("t.rate") > F.col("c.rate")
    lift = F.abs(F.col("t.rate") - F.col("c.rate"))
    winner = F.when(treatment_wins, F.col("t.name")).otherwise(F.col("c.name"))
    return best.select(
        "test_id",
        F.when(lift == 0, "no difference").otherwise(winner).alias("winner"),
        lift.cast("decimal(20,2)").alias("lift_points"),
    )
