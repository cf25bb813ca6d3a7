import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillwork import catalog
from tillwork.operators import bayes, quality
from tillwork.plans import dims, facts, report
from tillwork.plans.monthly import run_month
from tillwork.plans.warehouse import bulk_load
from tillwork.session import work_path
from tillwork.sources import files
from tillwork.streaming import experiment as stream

RUN = dt.datetime(2020, 1, 1)
ts = dt.datetime


@pytest.fixture(scope="module")
def shop(spark):
    """A tiny shop that reaches every branch of the loaders."""
    customers = spark.createDataFrame(
        [(c, "u" + c, "01000", "sao paulo", "SP") for c in ("c0", "c1", "c2", "c3")],
        catalog.OPERATIONAL["customers"],
    )
    orders = spark.createDataFrame(
        [
            ("o1", "c1", "delivered", ts(2017, 11, 1), None, None, None, None),
            ("o2", "c2", "shipped", ts(2017, 11, 2), None, None, None, None),
            ("o3", "c2", "created", ts(2017, 11, 2), None, None, None, None),  # same time as o2
            ("o4", "c3", "created", ts(2017, 11, 30), None, None, None, None),  # no items, no payment
            ("o5", "zz", "created", ts(2017, 11, 5), None, None, None, None),  # unknown customer
        ],
        catalog.OPERATIONAL["orders"],
    )
    items = spark.createDataFrame(
        [
            ("o1", 1, "p1", "s1", None, 100.0, 10.0),
            ("o2", 1, "p1", "s1", None, 50.0, 5.0),
            ("o2", 2, "p2", "s2", None, 20.0, 2.5),
            ("o3", 1, "p2", "s2", None, 20.0, 2.5),
            ("o5", 1, "p2", "s2", None, 20.0, 2.5),
        ],
        "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp_ntz, "
        "price double, freight_value double",
    ).withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("price", "freight_value")})
    payments = spark.createDataFrame(
        [("o1", 1, "credit_card", 3, 60.0), ("o1", 2, "voucher", 1, 50.0), ("o2", 1, "boleto", 1, 77.5)],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    ).withColumn("payment_value", F.col("payment_value").cast("decimal(10,2)"))
    reviews = spark.createDataFrame(
        [
            ("r1", "o1", 5, None, "great", ts(2017, 11, 10)),
            ("r2", "o2", 2, None, None, ts(2017, 11, 11)),  # two items
            ("r3", "o4", 4, None, "", ts(2017, 12, 1)),  # no items
        ],
        catalog.OPERATIONAL["order_reviews"],
    )
    products = spark.createDataFrame(
        [("p1", "cama", 5, 5, 1, 1001.0, 10.0, 10.0, 101.0), ("p2", None, 5, 5, 1, None, 10.0, 10.0, 10.0)],
        "product_id string, product_category_name string, product_name_length int, product_description_length int, "
        "product_photos_qty int, product_weight_g double, product_length_cm double, product_height_cm double, "
        "product_width_cm double",
    )
    sellers = spark.createDataFrame(
        [("s1", "1", "x", "SP"), ("s2", "2", "y", "RJ"), ("s3", "3", "z", "RJ")], catalog.OPERATIONAL["sellers"]
    )
    return {
        "customers": customers, "orders": orders, "order_items": items, "order_payments": payments,
        "order_reviews": reviews, "products": products, "sellers": sellers,
    }


@pytest.fixture(scope="module")
def warehouse(spark, shop):
    return bulk_load(spark, shop, work_path(spark, "test-star"), RUN)


def test_dim_customer(warehouse):
    got = {r.customer_id: r for r in warehouse.read("dim_customer").collect()}
    assert (got["c1"].customer_segment, got["c1"].total_orders) == ("returning", 2)  # two payments, one order
    assert (got["c2"].customer_segment, got["c2"].total_orders) == ("new", 1)  # the unpaid order is not counted
    assert (got["c0"].customer_segment, got["c0"].total_orders, float(got["c0"].lifetime_value)) == ("regular", 0, 0)
    assert sorted(r.customer_key for r in got.values()) == [1, 2, 3, 4]


def test_dim_seller_and_product(warehouse):
    sellers = {r.seller_id: r for r in warehouse.read("dim_seller").collect()}
    assert (sellers["s1"].seller_segment, sellers["s1"].total_sales) == ("small", 2)
    assert (sellers["s3"].seller_segment, sellers["s3"].total_sales) == ("large", 0)
    products = {r.product_id: r for r in warehouse.read("dim_product").collect()}
    assert (products["p1"].is_heavy_item, products["p1"].is_large_item) == (True, True)
    assert (products["p2"].is_heavy_item, products["p2"].is_large_item) == (None, False)


def test_facts(warehouse):
    sales = {(r.order_id, r.order_item_id): r for r in warehouse.read("fact_sales").collect()}
    assert sorted(sales) == [("o1", 1), ("o2", 1), ("o2", 2), ("o3", 1)]  # o5 has no customer
    assert sales["o2", 1].is_first_purchase and sales["o3", 1].is_repeat_customer
    assert all(r.is_first_purchase != r.is_repeat_customer for r in sales.values())
    assert sorted(r.sale_key for r in sales.values()) == [1, 2, 3, 4]
    orders = {r.order_id: r for r in warehouse.read("fact_orders").collect()}
    assert sorted(orders) == ["o1", "o2", "o3", "o4"]
    assert (float(orders["o2"].total_order_value), orders["o2"].item_count) == (77.5, 2)
    assert (float(orders["o4"].total_order_value), orders["o4"].item_count) == (0.0, 0)
    assert warehouse.read("fact_payments").count() == 3
    reviews = warehouse.read("fact_reviews")
    assert {r.review_id: r["count"] for r in reviews.groupBy("review_id").count().collect()} == {
        "r1": 1, "r2": 2, "r3": 1,
    }
    assert reviews.where("not has_comment and comment_length <> 0").count() == 0


def test_declared_constraints_hold(warehouse):
    tables = {name: warehouse.read(name) for name in catalog.ANALYTICS if name != "bayesian_priors_store"}
    report_rows = quality.star_report(tables)
    assert [r.check_name for r in report_rows.collect() if not r.passed] == []
    short = tables["dim_date"].where(F.col("full_date") < F.lit(dt.date(2017, 12, 1)))
    with pytest.raises(quality.QualityError, match="review_date_key: 1"):
        quality.enforce(quality.star_report({**tables, "dim_date": short}))


def test_month_reads_one_partition(warehouse):
    plan = warehouse.month("fact_sales", 2017, 11)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_month" in plan


def test_run_month(spark, warehouse):
    store = files.empty_table(spark, catalog.ANALYTICS["bayesian_priors_store"])
    period, test_id = dt.date(2017, 11, 1), dims.COUPON_TEST["test_id"]
    result = run_month(warehouse, store, period, test_id, RUN)
    kinds = {(r.value_type, r.period_date) for r in result.store.collect()}
    assert kinds == {("posterior", period), ("prior", dt.date(2017, 12, 1))}
    summary = result.summary.first()
    assert (summary.total_orders, summary.total_line_items, float(summary.total_revenue)) == (3, 4, 210.0)
    assert float(summary.avg_order_value) == 70.0
    assert sum(r.customers for r in result.segments.collect()) == summary.unique_customers
    assert sum(r.users for r in result.ab.collect()) == 4
    assert result.status.first().report_period == "2017-11"
    assert {r.rule for r in result.insights.collect()} == {
        "high_order_value", "cross_selling", "ab_impact", "retention", "continue_testing", "inventory",
    }


def test_empty_events_fail_the_month(warehouse):
    with pytest.raises(quality.QualityError):
        quality.enforce(quality.check_events(warehouse.read("fact_ab_test_events").where("false")))


def test_golden_ratios(spark):
    """2,358,287.54 over 7,451 orders of 17,330 lines is 316.51 each and 2.33 lines."""
    pre = spark.createDataFrame([(20171101, "2358287.54", 17330, 7451)], "k int, v string, n long, o long")
    sales = pre.select(F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"), "v", "o", "k").select(
        (F.col("i") % F.col("o")).alias("customer_key"),
        (F.col("i") % F.col("o")).cast("string").alias("order_id"),
        F.col("k").alias("order_date_key"),
        F.when(F.col("i") == 1, F.col("v").cast("decimal(12,2)")).otherwise(0).cast("decimal(12,2)").alias("total_value"),
    )
    row = report.exec_summary_full(sales, 2017, 11).first()
    assert (float(row.avg_order_value), float(row.items_per_order)) == (316.51, 2.33)
    assert (row.total_orders, row.total_line_items) == (7451, 17330)


def test_loading_orders_twice_adds_nothing(shop, warehouse):
    rows = facts.build_fact_orders(shop["orders"], shop["order_items"], warehouse.read("dim_customer"))
    again = facts.build_fact_orders(
        shop["orders"], shop["order_items"], warehouse.read("dim_customer"), target=rows
    )
    assert again.count() == rows.count() == 4


def test_customer_merge_keeps_first_date(shop):
    early = shop["orders"].where("order_id <> 'o1'")
    stored = dims.build_dim_customer(shop["customers"], early, shop["order_payments"], run_ts=RUN)
    merged = dims.build_dim_customer(
        shop["customers"], shop["orders"], shop["order_payments"], target=stored, run_ts=ts(2021, 1, 1)
    )
    c1 = merged.where("customer_id = 'c1'").first()
    assert (c1.total_orders, c1.first_order_date, c1.last_order_date) == (2, None, dt.date(2017, 11, 1))
    assert (c1.created_at, c1.updated_at) == (RUN, ts(2021, 1, 1))


def test_csv_round_trip_of_awkward_text(spark, rows):
    schema = catalog.OPERATIONAL["order_reviews"]
    df = spark.createDataFrame(
        [("1", "o", 5, 'say "hi", ok', "two\nlines, \"quoted\"", ts(2017, 1, 1)), ("2", "o", None, None, "\\ back", None)],
        schema,
    )
    path = files.sink_csv(df, work_path(spark, "text-csv"))
    back = files.scan_csv(spark, path, schema)
    assert rows(back, "review_id") == rows(df, "review_id")


def test_stream_replay_changes_nothing(spark, retail):
    """The same events again from a fresh checkpoint leave the same table."""
    path = work_path(spark, "replay")
    tables = []
    for _ in range(2):
        s = stream.event_stream(spark, retail.sf_dir)
        stream.stream_ab_counts(s, path, work_path(spark, "replay-state")).awaitTermination()
        tables.append(sorted(map(tuple, files.scan_published(spark, path).collect())))
    static = retail.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    batch = sorted(map(tuple, stream.daily_counts(static).collect()))
    assert tables[0] == tables[1] == batch


def test_a_version_is_published_whole(spark):
    path = work_path(spark, "published")
    with pytest.raises(FileNotFoundError):
        files.scan_published(spark, path)
    for version in (0, 1, 2, 1):
        files.publish(spark.range(version + 1), path, version)
    assert files.scan_published(spark, path).count() == 3
    files.publish(spark.range(99), path, 2)  # a replay
    assert files.scan_published(spark, path).count() == 3
    spark.range(9).write.parquet(f"{path}/v=7")
    os.remove(f"{path}/v=7/_SUCCESS".removeprefix("file:"))  # broken off
    assert files.scan_published(spark, path).count() == 3


def test_successes_never_exceed_trials(spark):
    """A purchase without a view is a trial too; another month does not count."""
    rows = [(1, ts(2024, 1, 5), "purchase"), (1, ts(2024, 1, 5, 9), "purchase"), (1, ts(2024, 1, 6), "view"), (2, ts(2024, 2, 1), "view")]
    events = spark.createDataFrame(rows, "user_id long, ts timestamp, event_type string")
    got = stream.daily_trials(events, dt.date(2024, 1, 15)).collect()
    assert sorted((r.user_id, r.bought) for r in got) == [(1, False), (1, True)]


def test_fresh_loads_hold_their_keys(spark, shop):
    doubled = shop["products"].unionByName(shop["products"].limit(1))
    with pytest.raises(Exception, match="more than one row"):
        dims.build_dim_product(doubled, run_ts=RUN).collect()
    customer = dims.build_dim_customer(shop["customers"], shop["orders"], shop["order_payments"], run_ts=RUN)
    orders = facts.build_fact_orders(shop["orders"].unionByName(shop["orders"]), shop["order_items"], customer)
    assert orders.count() == orders.select("order_id").distinct().count() == 4


def test_saving_again_keeps_ids_and_sets_the_time(spark):
    store = files.empty_table(spark, catalog.ANALYTICS["bayesian_priors_store"])
    rows = spark.createDataFrame(
        [("t", "A", dt.date(2020, 1, 1), 2.0, 3.0, "prior", 3, 1, "historical", "n", True), ("t", "B", dt.date(2020, 1, 1), 2.0, -1.0, "prior", 1, 3, "historical", "n", False)],
        "test_id string, variant_id string, period_date date, alpha_value double, beta_value double, value_type string, "
        "data_points long, conversions long, calculation_method string, notes string, is_valid boolean",
    )
    once = bayes.save_prior(store, rows, RUN)
    twice = bayes.save_prior(once, rows, ts(2021, 1, 1))
    assert [(r.variant_id, r.prior_id, r.created_at) for r in twice.collect()] == [("A", 1, ts(2021, 1, 1))]
    other = bayes.save_posterior(twice, rows.withColumn("test_id", F.lit("u")).drop("is_valid"), RUN)
    rolled = bayes.roll_forward(other, dt.date(2020, 1, 1), dt.date(2020, 2, 1), RUN, "t")
    assert rolled.count() == other.count() == 3 and sorted(r.prior_id for r in rolled.collect()) == [1, 2, 3]
