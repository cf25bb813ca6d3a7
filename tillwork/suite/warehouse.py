"""Warehouse builders over the sample tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillwork.plans import dims, facts
from tillwork.suite.basics import STATUS_VALUES
from tillwork.suite.joins_aggs import customer_keys, product_keys, sales, seller_keys
from tillwork.suite.parts import date_key, oracle
from tillwork.suite.registry import query

TS = "order_purchase_timestamp"


@query(
    "build_dim_customer",
    oracle("""
    SELECT customer_key, customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
           customer_segment, first_order_date, last_order_date, total_orders,
           CAST(lifetime_value AS DOUBLE) AS lifetime_value FROM d_customer"""),
)
def build_dim_customer(r):
    return dims.build_dim_customer(r.customers, r.orders, r.payments).drop("created_at", "updated_at")


@query(
    "build_dim_customer_merge",
    oracle("""
    SELECT n.customer_key, n.customer_id, n.customer_segment, n.total_orders, CAST(n.lifetime_value AS DOUBLE) AS lifetime_value,
           o.first_order_date, n.last_order_date
    FROM d_customer n LEFT JOIN (
        SELECT customer_id, CAST(min(order_purchase_timestamp) AS DATE) AS first_order_date
        FROM r_orders o JOIN r_payments p ON o.order_id = p.order_id
        WHERE order_purchase_timestamp >= TIMESTAMP '1998-01-01' GROUP BY customer_id) o
      ON n.customer_id = o.customer_id"""),
)
def build_dim_customer_merge(r):
    """A dimension loaded from later orders only, then merged with all of them.

    Totals refresh; the first order date keeps its stored, later value.
    """
    later = r.orders.where(F.col(TS) >= F.lit("1998-01-01").cast("timestamp_ntz"))
    stored = dims.build_dim_customer(r.customers, later, r.payments, run_ts=dt.datetime(2019, 1, 1))
    merged = dims.build_dim_customer(
        r.customers, r.orders, r.payments, target=stored, run_ts=dt.datetime(2020, 1, 1)
    )
    return merged.select(
        "customer_key", "customer_id", "customer_segment", "total_orders", "lifetime_value",
        "first_order_date", "last_order_date",
    )


@query(
    "build_dim_product",
    oracle("""
    SELECT product_key, product_id, product_category_name, product_name_length, product_description_length,
           product_photos_qty, CAST(product_weight_g AS DOUBLE) AS product_weight_g,
           CAST(product_length_cm AS DOUBLE) AS product_length_cm, CAST(product_height_cm AS DOUBLE) AS product_height_cm,
           CAST(product_width_cm AS DOUBLE) AS product_width_cm, is_heavy_item, is_large_item FROM d_product"""),
)
def build_dim_product(r):
    return dims.build_dim_product(r.products).drop("created_at", "updated_at")


@query(
    "build_dim_seller",
    oracle("""
    SELECT seller_key, seller_id, seller_zip_code_prefix, seller_city, seller_state, seller_segment, first_sale_date,
           last_sale_date, total_sales, CAST(total_revenue AS DOUBLE) AS total_revenue FROM d_seller"""),
)
def build_dim_seller(r):
    return dims.build_dim_seller(r.sellers, r.items, r.orders).drop("avg_rating", "created_at", "updated_at")


@query(
    "build_dim_date",
    oracle(f"""
    SELECT {date_key('d')} AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(month(d) AS INTEGER) AS month, rpad(monthname(d), 9, ' ') AS month_name, CAST(week(d) AS INTEGER) AS week,
           CAST(week(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
           CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
           rpad(dayname(d), 9, ' ') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT CAST(unnest(generate_series(min(CAST({TS} AS DATE)), max(CAST({TS} AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
          FROM r_orders)"""),
)
def build_dim_date(r):
    return dims.build_dim_date(dims.purchase_range(r.orders)).drop("created_at")


@query(
    "build_dim_order_status",
    oracle(f"""
    SELECT CAST(s.status_order AS BIGINT) AS status_key, s.status_value, s.status_description, s.is_final_status,
           CAST(s.status_order AS INTEGER) AS status_order, count(o.order_id) AS orders
    FROM (VALUES {STATUS_VALUES}) AS s(status_value, status_description, is_final_status, status_order)
    LEFT JOIN r_orders o ON o.order_status = s.status_value GROUP BY ALL"""),
)
def build_dim_order_status(r):
    """The status dimension with the orders that refer to each of its rows."""
    used = r.orders.groupBy(F.col("order_status").alias("status_value")).agg(F.count(F.lit(1)).alias("n"))
    statuses = dims.build_dim_order_status(r.spark).join(used, "status_value", "left")
    return statuses.withColumn("orders", F.coalesce("n", F.lit(0)).cast("bigint")).drop("n")


@query(
    "build_fact_sales",
    oracle("""
    SELECT customer_key, product_key, seller_key, order_date_key, order_id, order_item_id, CAST(price AS DOUBLE) AS price,
           CAST(freight_value AS DOUBLE) AS freight_value, CAST(total_value AS DOUBLE) AS total_value,
           is_first_purchase, is_repeat_customer FROM f_sales"""),
)
def build_fact_sales(r):
    return sales(r)


@query(
    "build_fact_orders",
    oracle(f"""
    SELECT customer_key, {date_key(TS)} AS purchase_date_key, o.order_id, CAST(coalesce(v, 0) AS DOUBLE) AS total_order_value,
           CAST(coalesce(f, 0) AS DOUBLE) AS total_freight_value, coalesce(n, 0) AS item_count
    FROM r_orders o JOIN k_customer k ON o.customer_id = k.customer_id
    LEFT JOIN (SELECT order_id, sum(price + freight_value) AS v, sum(freight_value) AS f, count(*) AS n
               FROM r_items GROUP BY order_id) t ON o.order_id = t.order_id"""),
)
def build_fact_orders(r):
    return facts.build_fact_orders(r.orders, r.items, customer_keys(r))


@query(
    "build_fact_payments",
    oracle(f"""
    SELECT customer_key, {date_key(TS)} AS payment_date_key, p.order_id, payment_sequential, payment_type,
           payment_installments, CAST(payment_value AS DOUBLE) AS payment_value,
           payment_installments > 1 AS is_installment_payment, payment_type = 'credit_card' AS is_credit_card
    FROM r_payments p JOIN r_orders o ON p.order_id = o.order_id JOIN k_customer k ON o.customer_id = k.customer_id"""),
)
def build_fact_payments(r):
    return facts.build_fact_payments(r.payments, r.orders, customer_keys(r))


def reviews(r):
    return facts.build_fact_reviews(
        r.reviews, r.orders, r.items, customer_keys(r), product_keys(r), seller_keys(r)
    )


@query(
    "build_fact_reviews",
    oracle("""
    SELECT customer_key, product_key, seller_key, review_date_key, review_id, order_id, review_score,
           review_comment_title, review_comment_message, has_comment, comment_length FROM f_reviews"""),
)
def build_fact_reviews(r):
    return reviews(r)


@query(
    "fact_orders_declared_measures",
    oracle(f"""
    SELECT o.order_id, coalesce(u, 0) AS unique_sellers,
           CAST(CASE order_status WHEN 'created' THEN 1 WHEN 'processing' THEN 3 WHEN 'delivered' THEN 5 END AS BIGINT) AS status_key,
           {date_key('order_approved_at')} AS approved_date_key,
           {date_key('order_delivered_customer_date')} AS delivered_date_key,
           {date_key('order_estimated_delivery_date')} AS estimated_delivery_date_key
    FROM r_delivery o LEFT JOIN (SELECT order_id, count(DISTINCT seller_id) AS u FROM r_items GROUP BY order_id) s
      ON o.order_id = s.order_id"""),
)
def fact_orders_declared_measures(r):
    return facts.order_declared_measures(
        r.orders_with_delivery, r.items, dims.build_dim_order_status(r.spark)
    )


@query(
    "dim_seller_avg_rating",
    oracle("""
    SELECT seller_key, CASE WHEN count(review_score) > 0 THEN
           CAST((200 * sum(review_score) + count(review_score)) // (2 * count(review_score)) AS DOUBLE) / 100 END AS avg_rating
    FROM f_reviews WHERE seller_key IS NOT NULL GROUP BY seller_key"""),
)
def dim_seller_avg_rating(r):
    return dims.seller_avg_rating(reviews(r))


@query(
    "build_ab_dims",
    oracle("""
    SELECT CAST(1 AS BIGINT) AS test_key, 'coupon_promo_v1' AS test_id, 'active' AS status,
           (SELECT CAST(min(order_purchase_timestamp) AS DATE) FROM r_orders) AS start_date,
           v.variant_key, v.variant_id, v.variant_name, v.is_control, CAST(50 AS DOUBLE) AS traffic_allocation
    FROM (SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'A', '10% Discount', TRUE),
                                (CAST(2 AS BIGINT), 'B', 'Free Shipping + 5%', FALSE))
          AS t(variant_key, variant_id, variant_name, is_control)) v"""),
)
def build_ab_dims(r):
    """Test and variants, started on the day of the first order."""
    tests, variants = dims.build_ab_dims(r.spark)
    first = r.orders.agg(F.min(TS).cast("date").alias("start_date")).scalar()
    return (
        tests.withColumn("start_date", first)
        .join(variants.drop("created_at"), "test_key")
        .select(
            "test_key", "test_id", "status", "start_date", "variant_key", "variant_id", "variant_name",
            "is_control", "traffic_allocation",
        )
    )
