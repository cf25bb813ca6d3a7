"""What moves the review text, and that repeats and strangers come out as they should."""

import datetime as dt
import re

from tillwork.plans import facts
from tillwork.plans.facts import BOUGHT

DAY = dt.datetime(2020, 1, 5)


def tables(spark):
    reviews = spark.createDataFrame(
        [("r1", "o1", 5, "t", "good", DAY), ("r1", "o1", 5, "t", "good", DAY), ("r2", "o2", 1, None, "", DAY), ("r3", "o3", 2, None, None, None),
         ("r4", "gone", 2, "t", "x", DAY), ("r5", None, 2, "t", "x", DAY)],
        "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string, review_creation_date timestamp_ntz",
    )
    orders = spark.createDataFrame([("o1", "c1", DAY), ("o2", "c2", DAY), ("o3", "c1", DAY), ("o4", "nobody", DAY)], f"order_id string, customer_id string, {BOUGHT} timestamp_ntz")
    items = spark.createDataFrame([("o1", "p1", "s1"), ("o1", "p2", "s9"), ("o1", None, "s1"), ("o3", "p1", "s1"), (None, "p1", "s1")], "order_id string, product_id string, seller_id string")
    customers = spark.createDataFrame([("c1", 1), ("c2", 2)], "customer_id string, customer_key long")
    products = spark.createDataFrame([("p1", 11), ("p2", 12)], "product_id string, product_key long")
    sellers = spark.createDataFrame([("s1", 21)], "seller_id string, seller_key long")
    return reviews, orders, items, customers, products, sellers


def test_rows(spark):
    got = facts.build_fact_reviews(*tables(spark)).collect()
    rows = sorted((r.review_id, r.customer_key, r.product_key or 0, r.seller_key or 0) for r in got)
    o1 = [("r1", 1, 0, 21), ("r1", 1, 0, 21), ("r1", 1, 11, 21), ("r1", 1, 11, 21), ("r1", 1, 12, 0), ("r1", 1, 12, 0)]
    # an order without items has one row, a review without a known order none
    assert rows == [*o1, ("r2", 2, 0, 0), ("r3", 1, 11, 21)]
    assert {r.review_id: r.review_date_key for r in got} == {"r1": 20200105, "r2": 20200105, "r3": None}
    assert {r.review_id: r.has_comment for r in got} == {"r1": True, "r2": False, "r3": False}


def test_one_shuffle_carries_text(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, -1)
    try:
        fact = facts.build_fact_reviews(*tables(spark))
        plan = spark._jvm.PythonSQLUtils.explainString(fact._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set(setting, before)
    moved = re.findall(r"^\(\d+\) Exchange *\nInput \[\d+\]: \[([^\]]*)\]", plan, re.M)
    assert len(moved) > 5 and len([columns for columns in moved if "review_comment_message" in columns]) == 1
