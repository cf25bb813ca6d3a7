"""The order book says what the separate sums said, and loads move items and review text less often."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwork.operators import pages
from tillwork.operators.windows import first_orders
from tillwork.plans import dims, facts, orderbook
from tillwork.session import work_path
from tillwork.sources import months
from tillwork.sources.files import keep
from tillwork.sources.months import MonthlyTable


def gathered(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def book(retail):
    return keep(orderbook.order_book(retail.orders_with_delivery, retail.items, retail.payments), "book")


def test_stats_agree(retail, book):
    orders, sellers = retail.orders, retail.items
    assert gathered(orderbook.customer_stats(book)) == gathered(dims.customer_stats(orders, retail.payments))
    assert gathered(orderbook.seller_stats(book)) == gathered(dims.seller_stats(sellers, orders))


def test_odd_items(spark):
    """Items without seller, order or price, an order twice, one without an id, one without items."""
    day = dt.datetime(2020, 1, 5)
    orders = spark.createDataFrame([(1, 7, day), (1, 7, day), (2, 7, day), (3, 8, day), (None, 8, day)], f"order_id long, customer_id long, {facts.BOUGHT} timestamp_ntz")
    items = spark.createDataFrame(
        [(1, 5, 1, 1), (1, 5, 2, 1), (1, None, 3, 1), (2, 6, None, 1), (None, 6, 4, 1), (9, 6, 4, 1)],
        "order_id long, seller_id long, price long, freight_value long",
    ).withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("price", "freight_value")})
    payments = spark.createDataFrame([(1, 5), (None, 6)], "order_id long, payment_value long").withColumn("payment_value", F.col("payment_value").cast("decimal(10,2)"))
    book = orderbook.order_book(orders, items, payments)
    assert gathered(orderbook.seller_stats(book)) == gathered(dims.seller_stats(items.where("seller_id is not null"), orders))
    assert gathered(orderbook.customer_stats(book)) == gathered(dims.customer_stats(orders, payments))
    keys = spark.createDataFrame([(7, 70), (8, 80)], "customer_id long, customer_key long")
    assert gathered(orderbook.build_fact_orders(book, keys, None)) == gathered(facts.build_fact_orders(orders, items, keys))


def test_items_move_once_for_the_book(retail):
    """The sums per seller and per order need no shuffle of their own."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark, before = retail.spark, retail.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(setting, -1)
    try:
        plan = orderbook.order_book(retail.orders, retail.items, retail.payments)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    assert plan.count("Exchange hashpartitioning(order_id") == plan.count("Exchange ") == 3


def test_ties_by_text(spark):
    orders = spark.createDataFrame([(9, 1, dt.datetime(2020, 1, 1)), (10, 1, dt.datetime(2020, 1, 1))], "o long, c long, t timestamp_ntz")
    assert [r.o for r in first_orders(orders, "c", "t", "o").collect()] == [9]
    assert [r.o for r in first_orders(orders, "c", "t", "o", as_text=True).collect()] == [10]


def test_rows_of_new_months_are_stored_once(spark, monkeypatch):
    """Only rows of months that are there already are compared and written a second time."""
    table = MonthlyTable(spark, work_path(spark, "sales"), "day")
    schema = "k long, order_id string, day int"
    table.merge(spark.createDataFrame([(None, "a", 20200105), (None, "n", None)], schema), ["order_id"], "k")
    kept = []
    monkeypatch.setattr(months, "keep", lambda df, label: kept.append(keep(df, label)) or kept[-1])
    batch = [(None, "a", 20200105), (None, "b", 20200106), (None, "n", None), (None, "m", None), *[(None, f"x{i}", 20200301) for i in range(20)]]
    table.merge(spark.createDataFrame(batch, schema), ["order_id"], "k")
    assert [df.count() for df in kept] == [24, 2]
    rows = table.read().collect()
    assert sorted(r.k for r in rows) == list(range(1, 25)) and len({r.order_id for r in rows}) == 24
    table.merge(spark.createDataFrame([(None, "z", 20200501)], schema), ["order_id"], "k")
    assert len(kept) == 3 and max(r.k for r in table.read().collect()) == 25


def test_stored_reviews_are_not_built_again(spark):
    day = dt.datetime(2020, 1, 5)
    reviews = spark.createDataFrame([(i, i % 40, 5, "t", "text", day) for i in range(60)], "review_id long, order_id long, review_score int, review_comment_title string, review_comment_message string, review_creation_date timestamp_ntz")
    orders = spark.createDataFrame([(i, 1, day) for i in range(50)], f"order_id long, customer_id long, {facts.BOUGHT} timestamp_ntz")
    items = spark.createDataFrame([(i % 50, 1, 1) for i in range(100)], "order_id long, product_id long, seller_id long")
    keys = [spark.createDataFrame([(1, 10)], f"{n}_id long, {n}_key long") for n in ("customer", "product", "seller")]
    whole = facts.build_fact_reviews(reviews, orders, items, *keys)
    assert whole.count() == 120
    stored = whole.withColumns({c: F.col(c).cast("string") for c in ("review_id", "order_id")}).where("review_id not in ('3', '55')")
    again = facts.build_fact_reviews(reviews, orders, items, *keys, stored=stored)
    # orders 3 and 15 have a review that is new, and another each that is not
    assert {r.order_id for r in again.collect()} == {3, 15}
    assert {3, 55} <= {r.review_id for r in again.collect()}


def test_pages_count_numbers_exactly(spark):
    rows = spark.range(100_000).select((F.col("id") % 70_000).alias("k"))
    counted = pages.distinct_counts(pages.distinct_pages(rows, "k"), "n")
    assert counted.first().n == 70_000 and counted.first().n == rows.distinct().count()
