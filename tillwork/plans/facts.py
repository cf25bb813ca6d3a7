"""Fact builders.  They read the keys of the dimensions and leave everything else alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions import rules
from tillwork.functions.dates import date_key
from tillwork.operators.aggregates import order_totals
from tillwork.operators.joins import fan_out, left_join_agg, resolve_dims
from tillwork.operators.merge import merge_insert_absent, one_per_key
from tillwork.operators.windows import first_orders

BOUGHT = "order_purchase_timestamp"


def keys_of(dim: DataFrame, name: str) -> DataFrame:
    """The (id, key) pairs of a dimension: ``name`` is customer, product or seller."""
    return dim.select(f"{name}_id", f"{name}_key")


def _orders_with_customer(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return orders.select("order_id", "customer_id", BOUGHT).join(
        keys_of(dim_customer, "customer"), "customer_id"
    )


def build_fact_sales(
    items: DataFrame,
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    text_ties: bool = False,
) -> DataFrame:
    """One row per order item whose order, customer, product and seller are known.

    Everything about the order is settled at order grain; the items, by far
    the larger side, are then joined to it once by order.  ``text_ties``: orders of one time go by their id as a string.
    """
    first = first_orders(orders, "customer_id", BOUGHT, "order_id", text_ties).withColumn("first", F.lit(True))
    known = (
        _orders_with_customer(orders, dim_customer)
        .join(first, "order_id", "left")
        .select(
            "order_id",
            "customer_key",
            date_key(F.col(BOUGHT)).alias("order_date_key"),
            F.coalesce("first", F.lit(False)).alias("is_first_purchase"),
        )
    )
    lines = items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
    resolved = resolve_dims(
        lines,
        [
            (known, "order_id"),
            (keys_of(dim_product, "product"), "product_id"),
            (keys_of(dim_seller, "seller"), "seller_id"),
        ],
    )
    return resolved.select(
        "customer_key",
        "product_key",
        "seller_key",
        "order_date_key",
        "order_id",
        "order_item_id",
        "price",
        "freight_value",
        rules.line_total(F.col("price"), F.col("freight_value")).alias("total_value"),
        "is_first_purchase",
        (~F.col("is_first_purchase")).alias("is_repeat_customer"),
    )


def build_fact_orders(
    orders: DataFrame, items: DataFrame, dim_customer: DataFrame, target: DataFrame | None = None
) -> DataFrame:
    """One row per order of a known customer; orders without items total 0."""
    totals = order_totals(items, "order_id", "price", "freight_value")
    rows = left_join_agg(
        _orders_with_customer(orders, dim_customer),
        totals,
        "order_id",
        ["total_value", "total_freight", "item_count"],
    ).select(
        "customer_key",
        date_key(F.col(BOUGHT)).alias("purchase_date_key"),
        "order_id",
        F.col("total_value").cast("decimal(20,2)").alias("total_order_value"),
        F.col("total_freight").cast("decimal(20,2)").alias("total_freight_value"),
        "item_count",
    )
    return one_per_key(rows, ["order_id"]) if target is None else merge_insert_absent(target, rows, ["order_id"])


def order_declared_measures(orders: DataFrame, items: DataFrame, statuses: DataFrame) -> DataFrame:
    """Per order: sellers involved, status key, and the keys of the later dates."""
    sellers = items.groupBy("order_id").agg(F.count_distinct("seller_id").alias("unique_sellers"))
    keyed = orders.join(
        statuses.select(F.col("status_value").alias("order_status"), "status_key"), "order_status", "left"
    )
    return left_join_agg(keyed, sellers, "order_id", ["unique_sellers"]).select(
        "order_id",
        "unique_sellers",
        "status_key",
        date_key(F.col("order_approved_at")).alias("approved_date_key"),
        date_key(F.col("order_delivered_customer_date")).alias("delivered_date_key"),
        date_key(F.col("order_estimated_delivery_date")).alias("estimated_delivery_date_key"),
    )


def build_fact_payments(payments: DataFrame, orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    known = _orders_with_customer(orders, dim_customer).select(
        "order_id", "customer_key", date_key(F.col(BOUGHT)).alias("payment_date_key")
    )
    flags = rules.payment_flags(F.col("payment_installments"), F.col("payment_type"))
    return payments.join(known, "order_id").select(
        "customer_key",
        "payment_date_key",
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
        *[c.alias(n) for n, c in flags.items()],
    )


def reviewed_orders(reviews: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The ids of orders with a review; with ``stored``, the fact so far, of those with a review that it lacks."""
    reviewed = reviews.select("review_id", "order_id")
    if stored is not None:
        seen = stored.select(*[F.col(c).try_cast(reviews.schema[c].dataType).alias(c) for c in reviewed.columns])
        reviewed = reviewed.join(seen, reviewed.columns, "left_anti")
    return reviewed.select("order_id").distinct()


def build_fact_reviews(
    reviews: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    stored: DataFrame | None = None,
    reviewed: DataFrame | None = None,
) -> DataFrame:
    """One row per review and item of its order (one row where the order has none).

    Orders with a review, few of all, are picked first, and the keys of their items meet as narrow rows.  With
    ``stored``, the fact so far, orders whose reviews are all in it are left out; ``reviewed`` are the
    ``reviewed_orders`` where they are known already.  The reviews with their text meet them
    in one inner join by order, whose sides can both be split where an order is hot: one shuffle moves text.
    """
    if reviewed is None:
        reviewed = reviewed_orders(reviews, stored)
    known = (
        _orders_with_customer(orders.join(reviewed, "order_id", "left_semi"), dim_customer)
        .select("order_id", "customer_key")
    )
    lines = (
        items.select("order_id", "product_id", "seller_id")
        .join(reviewed, "order_id", "left_semi")
        .join(keys_of(dim_product, "product"), "product_id", "left")
        .join(keys_of(dim_seller, "seller"), "seller_id", "left")
        .select("order_id", "product_key", "seller_key")
    )
    flags = rules.review_flags(F.col("review_comment_message"))
    return (
        reviews.join(fan_out(known, lines, "order_id"), "order_id")
        .select(
            "customer_key",
            "product_key",
            "seller_key",
            date_key(F.col("review_creation_date")).alias("review_date_key"),
            "review_id",
            "order_id",
            "review_score",
            "review_comment_title",
            "review_comment_message",
            *[c.alias(n) for n, c in flags.items()],
        )
    )
