import datetime as dt
from decimal import Decimal
from math import asin, lgamma, exp, pi, prod, sin, sqrt

import pytest
from pyspark.sql import functions as F

from tillwork.functions import beta
from tillwork.operators import bayes, experiment
from tillwork.plans import dims
from tillwork.suite.joins_aggs import two_tests

DAY, NEXT = dt.date(2018, 10, 1), dt.date(2018, 11, 1)
TEST = "coupon_promo_v1"
RUN_TS = dt.datetime(2020, 1, 1)


def pair(spark, a1, b1, a2, b2):
    return spark.createDataFrame(
        [(TEST, DAY, "A", True, a1, b1), (TEST, DAY, "B", False, a2, b2)],
        "test_id string, period_date date, variant_id string, is_control boolean, alpha_value double, beta_value double",
    )


@pytest.mark.parametrize(
    "params, want",
    [
        ((27074, 22484, 27879, 22008), 0.99996474688),
        ((3, 5, 4, 4), 0.70396270396),
        ((1, 1, 1, 1), 0.5),
        ((1, 1, 2, 1), 2 / 3),
        # no size at which another answer is given, whichever side is large
        ((1, 999_999, 5, 999_990), 1 - prod((999_990 + i) / (1_999_989 + i) for i in range(5))),
        ((1, 1_000_100, 5, 1_000_100), 1 - prod((1_000_100 + i) / (2_000_200 + i) for i in range(5))),
        ((10**9, 10**9, 1, 1), 0.5),
        ((1, 1, 10**9, 10**9), 0.5),
        ((3_000_000, 1, 1, 1), 1 / 3_000_001),
        ((1.5, 10.5, 2.9, 9.9), 0.76972134),
        ((0.5, 0.5, 0.5, 0.5), 0.5),
        ((0.01, 0.01, 0.01, 0.01), 0.5),
        ((10**9, 10**9, 10**9, 10**9), 0.5),
        ((0.5, 0.5, 10**9, 2 * 10**9), 2 / pi * asin(sqrt(1 / 3))),
    ],
)
def test_probability(spark, params, want):
    exact = bayes.prob_b_beats_a(pair(spark, *map(float, params))).first().prob_treatment_better
    assert exact == pytest.approx(want, abs=1e-8)


def test_probability_of_any_sizes(spark):
    """Against a control of Beta(k, 1): the mean of x**k, in closed form."""
    sizes = (0.5, 1.0, 3.7, 40.0, 1e3, 1e6, 1e9)
    cases = [(k, a, b) for k in (1, 2, 7) for a in sizes for b in sizes]
    rows = [(str(i), DAY, "A", True, float(k), 1.0) for i, (k, _, _) in enumerate(cases)]
    rows += [(str(i), DAY, "B", False, a, b) for i, (_, a, b) in enumerate(cases)]
    df = spark.createDataFrame(rows, "test_id string, period_date date, variant_id string, is_control boolean, alpha_value double, beta_value double")
    got = {int(r.test_id): r.prob_treatment_better for r in bayes.prob_b_beats_a(df).collect()}
    for i, (k, a, b) in enumerate(cases):
        assert got[i] == pytest.approx(prod((a + j) / (a + b + j) for j in range(k)), abs=1e-9)


def test_cdf_and_quantiles(spark):
    """Closed forms: powers, the arcsine law, whole parameters, and each the inverse of the other."""
    shares = [0.001, 0.025, 0.3, 0.5, 0.975, 0.9999]
    cases = [(0.5, 0.5), (1.0, 1.0), (2.5, 1.0), (1.0, 7e5), (3.0, 4.0), (0.1, 30.0), (27074.0, 22484.0), (1e9, 5e8), (1e6, 0.7)]
    df = spark.createDataFrame(cases, "a double, b double").withColumn("x", beta.quantiles(shares, F.col("a"), F.col("b")))
    back = df.withColumn("p", F.array(*[beta.cdf(F.col("x")[i], F.col("a"), F.col("b")) for i in range(len(shares))]))
    exact = {
        (0.5, 0.5): lambda x: 2 / pi * asin(sqrt(x)), (1.0, 1.0): lambda x: x, (2.5, 1.0): lambda x: x**2.5,
        (1.0, 7e5): lambda x: 1 - (1 - x) ** 7e5,
        (3.0, 4.0): lambda x: sum(exp(lgamma(7) - lgamma(j + 1) - lgamma(7 - j)) * x**j * (1 - x) ** (6 - j) for j in range(3, 7)),
    }
    for r in back.collect():
        assert r.p == pytest.approx(shares, abs=1e-9) or r.a == 1e6
        if (r.a, r.b) in exact:
            assert [exact[r.a, r.b](x) for x in r.x] == pytest.approx(shares, abs=1e-9)
    assert dict(((r.a, r.b), r.x[1]) for r in back.collect())[0.5, 0.5] == pytest.approx(sin(pi * 0.0125) ** 2, abs=1e-12)
    ends = spark.range(1).select(beta.cdf(F.lit(0.0), F.lit(2.0), F.lit(3.0)), beta.cdf(F.lit(1.0), F.lit(2.0), F.lit(3.0))).first()
    assert tuple(ends) == (0.0, 1.0)


def test_a_table_size_does_not_change_the_decision(spark):
    row = bayes.prob_b_beats_a(pair(spark, 1.0, 1_000_100.0, 5.0, 1_000_100.0))
    assert row.select(bayes.decide(F.col("prob_treatment_better")).alias("d")).first().d == "significant"


def test_invalid_parameters_give_null(spark):
    row = bayes.prob_b_beats_a(pair(spark, 5.0, -3.0, 2.0, 2.0))
    row = row.select("prob_treatment_better", bayes.decide(F.col("prob_treatment_better")).alias("d")).first()
    assert (row.prob_treatment_better, row.d) == (None, "invalid")
    ci = bayes.credible_interval(pair(spark, 5.0, -3.0, 2.0, 2.0)).where("variant_id = 'A'").first()
    assert (ci.ci_low, ci.ci_high) == (None, None)


def test_credible_interval(spark):
    ci = bayes.credible_interval(pair(spark, 27074.0, 22484.0, 1.0, 1.0)).orderBy("variant_id").collect()
    assert ci[0].ci_low == pytest.approx(0.54192, abs=2e-5)
    assert ci[0].ci_high == pytest.approx(0.55069, abs=2e-5)
    assert (ci[1].ci_low, ci[1].ci_high) == (pytest.approx(0.025, abs=1e-3), pytest.approx(0.975, abs=1e-3))


@pytest.fixture
def counts(spark):
    return spark.createDataFrame(
        [
            (TEST, "A", DAY, 10, 4),
            (TEST, "B", DAY, 12, 6),
            (TEST, "A", NEXT, 20, 5),
        ],
        "test_id string, variant_id string, period_date date, data_points long, conversions long",
    )


def test_chain_equals_month_by_month(spark, counts, rows):
    chain = bayes.monthly_chain(counts)
    store = bayes.chain_as_store(chain)
    base = store.where("value_type = 'prior'").where(F.col("period_date") == F.lit(DAY))
    for current, following in ((DAY, NEXT), (NEXT, dt.date(2018, 12, 1))):
        prior = base.where((F.col("period_date") == F.lit(current)) & (F.col("value_type") == "prior"))
        month = counts.where(F.col("period_date") == F.lit(current))
        base = bayes.save_posterior(base, bayes.posterior(prior, month), RUN_TS)
        base = bayes.roll_forward(base, current, following, RUN_TS)
    cols = ["variant_id", "period_date", "alpha_value", "beta_value"]
    stepped = base.where("value_type = 'posterior'").select(cols)
    chained = store.where("value_type = 'posterior'").select(cols)
    assert rows(stepped, *cols) == rows(chained, *cols)


def test_saving_twice_keeps_method_and_key(spark, counts):
    store = bayes.chain_as_store(bayes.monthly_chain(counts)).withColumn("calculation_method", F.lit("first"))
    fresh = bayes.posterior(store.where(F.lit(False)), counts)
    once = bayes.save_posterior(store, fresh, dt.datetime(2020, 1, 1))
    assert once.count() == store.count()
    got = once.where("value_type = 'posterior' and variant_id = 'B'").first()
    assert (got.alpha_value, got.calculation_method) == (Decimal("7.000000"), "first")


def test_missing_posterior_rolls_nothing(spark, counts):
    store = bayes.chain_as_store(bayes.monthly_chain(counts))
    assert bayes.roll_forward(store, dt.date(2017, 1, 1), DAY, RUN_TS).count() == store.count()


def events(spark, rows):
    return spark.createDataFrame(
        rows, "customer_key long, test_key long, variant_key long, event_date_key int, event_type string, is_conversion boolean"
    )


def test_priors_count_users_and_rows(spark):
    tests, variants = dims.build_ab_dims(spark)
    e = events(spark, [
        (1, 1, 1, 20181001, "exposure", True), (1, 1, 1, 20181001, "exposure", True),
        (1, 1, 1, 20181001, "exposure", True), (2, 1, 2, 20181001, "exposure", False),
        (3, 1, 2, 20181018, "exposure", True), (4, 1, 2, 20181001, "click", True),
    ])
    cutoff = dt.date(2018, 10, 17)
    by_row = {r.variant_id: r for r in bayes.historical_prior(e, tests, variants, TEST, cutoff).collect()}
    assert (by_row["A"].data_points, by_row["A"].conversions) == (1, 3)
    assert by_row["A"].beta_value == -1 and not by_row["A"].is_valid and by_row["A"].prior_mean is None
    assert (by_row["B"].data_points, by_row["B"].conversions, by_row["B"].is_valid) == (1, 0, True)
    by_user = {r.variant_id: r for r in bayes.customer_level_prior(e, tests, variants, TEST, cutoff).collect()}
    assert (by_user["A"].alpha_value, by_user["A"].beta_value) == (2, 1)


def test_exposures_and_reruns(spark):
    tests, variants = dims.build_ab_dims(spark)
    customers = spark.createDataFrame(
        [(1, "c1", 1), (2, "c2", 2), (3, "c3", 0)], "customer_key long, customer_id string, total_orders long"
    )
    sales = spark.createDataFrame([(1, 10.0), (1, 100.0), (2, 10.0)], "customer_key long, total_value double")
    sales = sales.withColumn("total_value", F.col("total_value").cast("decimal(12,2)"))
    day = F.lit(dt.date(2018, 10, 17))
    e = experiment.exposure_events(customers, sales, tests, variants, day, TEST)
    got = sorted((r.customer_key, float(r.conversion_value), r.is_conversion) for r in e.collect())
    # threshold 1.2 * 40 = 48; customer 2 converts for having two order payments
    assert got == [(1, 10.0, False), (1, 100.0, True), (2, 10.0, True), (3, 0.0, False)]
    assert experiment.new_exposures(e, e).count() == 0
    assert experiment.new_exposures(e, e.where("customer_key = 1")).count() == 2
    none = experiment.exposure_events(customers, sales.where("false"), tests, variants, day, TEST)
    assert none.count() == 0


def test_assignment_is_stable_and_even(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    first = experiment.assign_variant(df, "id")
    again = experiment.assign_variant(df.repartition(13), "id")
    assert first.join(again, ["id", "variant_id"]).count() == 20000
    share = first.where("variant_id = 'A'").count() / 20000
    assert 0.48 < share < 0.52
    with pytest.raises(ValueError):
        experiment.assign_variant(df, "id", {"A": 60, "B": 50})


def test_golden_rates_and_conclusion(spark):
    """27,073 of 49,556 against 27,878 of 49,885; a second test with the same ids changes nothing."""
    tests, variants = two_tests_frames(spark)
    store = spark.createDataFrame(
        [
            (TEST, "A", NEXT, "posterior", 49556, 27073),
            (TEST, "B", NEXT, "posterior", 49885, 27878),
            (TEST, "A", DAY, "posterior", 10, 9),
        ],
        "test_id string, variant_id string, period_date date, value_type string, data_points long, conversions long",
    )
    rates = bayes.report_rates(store, variants, tests, TEST)
    got = [(r.variant_name, r.users, r.conversions, float(r.conversion_rate)) for r in rates.orderBy("variant_id").collect()]
    assert got == [("10% Discount", 49556, 27073, 54.63), ("Free Shipping + 5%", 49885, 27878, 55.88)]
    end = bayes.conclusion(rates).first()
    assert (end.winner, end.lift_points) == ("Free Shipping + 5%", Decimal("1.25"))


def two_tests_frames(spark):
    class Holder:
        pass

    holder = Holder()
    holder.spark = spark
    return two_tests(holder)
