"""Dimension builders.

Each builder returns the dimension for a fresh load, or, given the stored
``target``, the merged one: known rows have only some columns refreshed, new
rows get the next keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions import dates, rules
from tillwork.functions.scalars import or_zero
from tillwork.operators.merge import (
    bare_keys,
    lacking_keys,
    merge_insert_absent,
    merge_upsert,
    require_unique,
    surrogate_key,
)
from tillwork.sources.files import values_table


def _load(
    rows: DataFrame,
    ids: DataFrame,
    target: DataFrame | None,
    natural: str,
    key: str,
    refreshed: Sequence[str],
    run_ts: dt.datetime | None,
    keys: DataFrame | None,
) -> DataFrame:
    """``rows`` with their keys, or ``target`` with ``rows`` merged in.

    Keys come from ``keys`` (natural, key), the stored map; without it the bare ``ids`` that ``target`` lacks
    are numbered.  Either way ``rows`` is evaluated once.  A row without an id has no key.
    """
    stamp = F.lit(run_ts).cast("timestamp_ntz")
    if keys is None:
        if target is None:
            keys = surrogate_key(bare_keys(ids, [natural]), natural, key)
        else:
            keys = lacking_keys(ids, target, [natural], key)
    if target is None:
        stamped = require_unique(rows.withColumns({"created_at": stamp, "updated_at": stamp}), [natural], key)
        return stamped.join(keys, natural, "left").select(key, *stamped.columns)
    return merge_upsert(
        target,
        rows.join(keys, natural, "left"),
        [natural],
        refreshed,
        touch_col="updated_at",
        run_ts=run_ts,
        insert_defaults={"created_at": run_ts},
    )


def customer_stats(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Per customer: order payments, spend, first and last order date.

    Payments shrink to one row per order before the join, so neither an order
    with very many payments nor a customer with very many orders is moved whole.
    """
    paid = payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("payment_value").alias("v")
    )
    return customer_sums(orders.select("order_id", "customer_id", "order_purchase_timestamp").join(paid, "order_id"))


def customer_sums(paid: DataFrame) -> DataFrame:
    """Sums per customer of orders with their number ``n`` and value ``v`` of payments."""
    bought = "order_purchase_timestamp"
    return paid.groupBy("customer_id").agg(
        F.sum("n").alias("order_count"),
        F.sum("v").cast("decimal(20,2)").alias("total_spent"),
        F.min(bought).cast("date").alias("first_order_date"),
        F.max(bought).cast("date").alias("last_order_date"),
    )


def build_dim_customer(
    customers: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    target: DataFrame | None = None,
    run_ts: dt.datetime | None = None,
    keys: DataFrame | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """``keys`` (customer_id, customer_key) is the stored key map, see ``KeyMap``; ``stats`` replaces ``customer_stats``."""
    stats = customer_stats(orders, payments) if stats is None else stats
    n, spent = F.col("order_count"), F.col("total_spent")
    rows = (
        customers.join(stats, "customer_id", "left")
        .select(
            "customer_id",
            "customer_unique_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
            rules.customer_segment(n, spent).alias("customer_segment"),
            "first_order_date",
            "last_order_date",
            or_zero(n).alias("total_orders"),
            or_zero(spent).cast("decimal(20,2)").alias("lifetime_value"),
        )
        # rows are placed by customer_id already, so this needs no shuffle of its own
        .distinct()
    )
    refreshed = ["customer_segment", "total_orders", "lifetime_value", "last_order_date"]
    return _load(rows, customers, target, "customer_id", "customer_key", refreshed, run_ts, keys)


def build_dim_product(
    products: DataFrame,
    target: DataFrame | None = None,
    run_ts: dt.datetime | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    size = [F.col(f"product_{side}_cm") for side in ("length", "height", "width")]
    rows = products.select(
        "product_id",
        "product_category_name",
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        *[c.alias(n) for n, c in rules.product_flags(F.col("product_weight_g"), *size).items()],
    )
    refreshed = ["product_category_name", "is_heavy_item", "is_large_item"]
    return _load(rows, products, target, "product_id", "product_key", refreshed, run_ts, keys)


def seller_stats(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per seller: lines sold, revenue with freight, first and last sale date."""
    bought = "order_purchase_timestamp"
    per_order = items.groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("price") + F.col("freight_value")).alias("v")
    )
    return seller_sums(per_order.join(orders.select("order_id", bought), "order_id"))


def seller_sums(sold: DataFrame) -> DataFrame:
    """Sums per seller of orders with their number ``n`` and value ``v`` of the seller's lines."""
    bought = "order_purchase_timestamp"
    return sold.groupBy("seller_id").agg(
        F.sum("n").alias("sales_count"),
        F.sum("v").cast("decimal(20,2)").alias("revenue"),
        F.min(bought).cast("date").alias("first_sale_date"),
        F.max(bought).cast("date").alias("last_sale_date"),
    )


def build_dim_seller(
    sellers: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    target: DataFrame | None = None,
    run_ts: dt.datetime | None = None,
    ratings: DataFrame | None = None,
    keys: DataFrame | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """``ratings`` (seller_id, avg_rating) fills the rating column when given; ``stats`` replaces ``seller_stats``."""
    joined = sellers.join(seller_stats(items, orders) if stats is None else stats, "seller_id", "left")
    rating = F.lit(None)
    if ratings is not None:
        joined = joined.join(ratings.select("seller_id", "avg_rating"), "seller_id", "left")
        rating = F.col("avg_rating")
    n = F.col("sales_count")
    rows = joined.select(
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
        rules.seller_segment(n).alias("seller_segment"),
        "first_sale_date",
        "last_sale_date",
        or_zero(n).alias("total_sales"),
        or_zero(F.col("revenue")).cast("decimal(20,2)").alias("total_revenue"),
        rating.cast("decimal(3,2)").alias("avg_rating"),
    )
    refreshed = ["seller_segment", "total_sales", "total_revenue", "last_sale_date"]
    if ratings is not None:
        refreshed.append("avg_rating")
    return _load(rows, sellers, target, "seller_id", "seller_key", refreshed, run_ts, keys)


def seller_avg_rating(fact_reviews: DataFrame) -> DataFrame:
    """Mean review score per seller; lines without a score do not count."""
    mean = F.sum("review_score").cast("decimal(20,0)") / F.nullif(F.count("review_score"), F.lit(0))
    return (
        fact_reviews.where(F.col("seller_key").isNotNull())
        .groupBy("seller_key")
        .agg(F.round(mean, 2).cast("decimal(3,2)").alias("avg_rating"))
    )


def purchase_range(orders: DataFrame) -> DataFrame:
    """One row: first and last purchase date."""
    bought = "order_purchase_timestamp"
    return orders.agg(
        F.min(bought).cast("date").alias("start_date"), F.max(bought).cast("date").alias("end_date")
    )


def date_range(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row: first and last day of any date that a fact refers to."""
    named = ["purchase_timestamp", "approved_at", "delivered_customer_date", "estimated_delivery_date"]
    dated = [f"order_{n}" for n in named if f"order_{n}" in orders.columns]

    def bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        return df.agg(
            F.array_min(F.array(*[F.min(c).cast("date") for c in columns])).alias("a"),
            F.array_max(F.array(*[F.max(c).cast("date") for c in columns])).alias("b"),
        )

    both = bounds(orders, dated).unionByName(bounds(reviews, ["review_creation_date"]))
    return both.agg(F.min("a").alias("start_date"), F.max("b").alias("end_date"))


def build_dim_date(
    bounds: DataFrame, target: DataFrame | None = None, run_ts: dt.datetime | None = None
) -> DataFrame:
    """A row per day between the bounds (one row of start_date, end_date), both included.

    Days already in ``target`` stay as they are.
    """
    d = F.col("full_date")
    days = bounds.select(dates.date_series(F.col("start_date"), F.col("end_date")).alias("full_date"))
    parts = dates.date_parts(d)
    rows = days.select(
        dates.date_key(d).alias("date_key"),
        d,
        *[c.alias(n) for n, c in parts.items()],
        parts["week"].alias("week_of_year"),
        *[c.alias(n) for n, c in dates.month_day_names(d).items()],
        dates.is_weekend(d).alias("is_weekend"),
        F.lit(run_ts).cast("timestamp_ntz").alias("created_at"),
    )
    return rows if target is None else merge_insert_absent(target, rows, ["date_key"])


def date_bounds(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return values_table(spark, [(start, end)], "start_date date, end_date date")


# The order statuses, their meaning, whether they are final, their order.
ORDER_STATUSES = [
    ("created", "Order created", False, 1),
    ("approved", "Payment approved", False, 2),
    ("processing", "Order being processed", False, 3),
    ("shipped", "Order shipped", False, 4),
    ("delivered", "Order delivered", True, 5),
    ("unavailable", "Product unavailable", True, 6),
    ("canceled", "Order canceled", True, 7),
    ("invoiced", "Order invoiced", False, 8),
]


def build_dim_order_status(spark: SparkSession) -> DataFrame:
    rows = [(key, *status) for key, status in enumerate(ORDER_STATUSES, start=1)]
    return values_table(
        spark,
        rows,
        "status_key bigint, status_value string, status_description string, "
        "is_final_status boolean, status_order int",
    )


# The standing coupon test and its two variants.
COUPON_TEST: dict[str, Any] = {
    "test_id": "coupon_promo_v1",
    "test_name": "Coupon Promotion Test",
    "test_type": "promotion",
    "hypothesis": "Free shipping offer will drive higher order values than percentage discount",
    "status": "active",
    "success_metric": "high_value_conversion",
}
COUPON_VARIANTS: list[dict[str, Any]] = [
    {
        "variant_id": "A",
        "variant_name": "10% Discount",
        "description": "10% off your entire order",
        "is_control": True,
        "traffic_allocation": 50.0,
    },
    {
        "variant_id": "B",
        "variant_name": "Free Shipping + 5%",
        "description": "Free shipping plus 5% discount",
        "is_control": False,
        "traffic_allocation": 50.0,
    },
]


def build_ab_dims(
    spark: SparkSession,
    test: Mapping[str, Any] = COUPON_TEST,
    variants: Sequence[Mapping[str, Any]] = COUPON_VARIANTS,
    start_date: dt.date | None = None,
    run_ts: dt.datetime | None = None,
    target: tuple[DataFrame, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The test dimension and the variant dimension.

    With ``target`` (tests, variants) only what is missing there is added.
    """
    stamp = F.lit(run_ts).cast("timestamp_ntz").alias("created_at")
    facts = ("test_id", "test_name", "test_type", "hypothesis", "status", "success_metric")
    test_rows = values_table(
        spark,
        [(1, *(test[c] for c in facts))],
        "test_key bigint, test_id string, test_name string, test_type string, hypothesis string, "
        "status string, success_metric string",
    ).select(
        "test_key", "test_id", "test_name", "test_type", "hypothesis",
        F.lit(start_date).cast("date").alias("start_date"), F.lit(None).cast("date").alias("end_date"),
        "status", "success_metric", stamp,
    )
    columns = ("variant_id", "variant_name", "description", "is_control", "traffic_allocation")
    # a fresh load numbers its few literal rows here; a merge continues the stored keys
    arms = values_table(
        spark,
        [(n, 1, *(v[c] for c in columns)) for n, v in enumerate(variants, start=1)],
        "variant_key bigint, test_key bigint, variant_id string, variant_name string, description string, "
        "is_control boolean, traffic_allocation double",
    ).withColumn("traffic_allocation", F.col("traffic_allocation").cast("decimal(5,2)"))
    variant_rows = arms.select("variant_key", "test_key", *columns, stamp)
    if target is None:
        return test_rows, variant_rows

    merged = merge_insert_absent(target[0], test_rows.drop("test_key"), ["test_id"])
    tests = surrogate_key(merged, "test_id", "test_key", buckets=1)
    owner = tests.where(F.col("test_id") == test["test_id"]).select("test_key").scalar()
    keyed = variant_rows.drop("variant_key").withColumn("test_key", owner)
    natural = ["test_key", "variant_id"]
    merged = merge_insert_absent(target[1], keyed, natural)
    return tests, surrogate_key(merged, natural, "variant_key", buckets=1)
