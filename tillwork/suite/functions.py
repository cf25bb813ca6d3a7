"""Scalar functions over the sample tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillwork.functions import dates, scalars
from tillwork.operators.relational import project
from tillwork.plans.dims import purchase_range
from tillwork.suite.basics import stored_chain
from tillwork.suite.parts import bucket, date_key, oracle
from tillwork.suite.registry import query


TS = "order_purchase_timestamp"


@query("fn_date_key", oracle(f"SELECT order_id, {date_key(TS)} AS date_key FROM r_orders"))
def fn_date_key(r):
    return r.orders.select("order_id", dates.date_key(F.col(TS)).alias("date_key"))


@query(
    "fn_date_parts",
    oracle(f"""
    SELECT order_id, CAST(year({TS}) AS INTEGER) AS year, CAST(quarter({TS}) AS INTEGER) AS quarter,
           CAST(month({TS}) AS INTEGER) AS month, CAST(weekofyear({TS}) AS INTEGER) AS week,
           CAST(day({TS}) AS INTEGER) AS day_of_month, CAST(dayofyear({TS}) AS INTEGER) AS day_of_year,
           CAST(dayofweek({TS}) AS INTEGER) AS day_of_week FROM r_orders"""),
)
def fn_date_parts(r):
    return project(r.orders, {"order_id": F.col("order_id"), **dates.date_parts(F.col(TS))})


@query(
    "fn_month_day_names",
    oracle(f"""
    SELECT order_id, rpad(monthname({TS}), 9, ' ') AS month_name, rpad(dayname({TS}), 9, ' ') AS day_name
    FROM r_orders"""),
)
def fn_month_day_names(r):
    return project(r.orders, {"order_id": F.col("order_id"), **dates.month_day_names(F.col(TS))})


@query("fn_is_weekend", oracle(f"SELECT order_id, dayofweek({TS}) IN (0, 6) AS is_weekend FROM r_orders"))
def fn_is_weekend(r):
    return r.orders.select("order_id", dates.is_weekend(F.col(TS)).alias("is_weekend"))


@query("fn_to_date_from_key", oracle(f"SELECT order_id, CAST({TS} AS DATE) AS day FROM r_orders"))
def fn_to_date_from_key(r):
    keyed = r.orders.select("order_id", dates.date_key(F.col(TS)).alias("k"))
    return keyed.select("order_id", dates.date_from_key(F.col("k")).alias("day"))


@query(
    "fn_date_series",
    oracle(f"""
    SELECT CAST(unnest(generate_series(min(CAST({TS} AS DATE)), max(CAST({TS} AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day
    FROM r_orders"""),
)
def fn_date_series(r):
    bounds = purchase_range(r.orders)
    return bounds.select(dates.date_series(F.col("start_date"), F.col("end_date")).alias("day"))


@query(
    "fn_coalesce_nullif",
    oracle("""
    SELECT product_id, CAST(coalesce(product_weight_g, 0) AS DOUBLE) AS weight, nullif(product_photos_qty, 0) AS photos,
           CAST(product_name_length AS DOUBLE) / nullif(product_photos_qty, 0) AS ratio FROM r_products"""),
)
def fn_coalesce_nullif(r):
    photos = F.col("product_photos_qty")
    return r.products.select(
        "product_id",
        scalars.or_zero(F.col("product_weight_g")).alias("weight"),
        F.nullif(photos, F.lit(0)).alias("photos"),
        scalars.safe_divide(F.col("product_name_length").cast("double"), photos).alias("ratio"),
    )


@query(
    "fn_round",
    """
    SELECT l_orderkey AS order_id, l_partkey AS part,
           CAST(round(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS r2,
           CAST(round(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2)), 1) AS DOUBLE) AS r1
    FROM lineitem""",
)
def fn_round(r):
    value = F.col("l_extendedprice").cast("decimal(10,2)") * F.col("l_discount").cast("decimal(4,2)")
    return r.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part"),
        scalars.round_half_up(value, 2).alias("r2"),
        scalars.round_half_up(value, 1).alias("r1"),
    )


@query(
    "fn_hash_bucket",
    oracle(f"SELECT customer_id, {bucket('customer_id', 2)} AS two, {bucket('customer_id', 10000)} AS many FROM r_customers"),
)
def fn_hash_bucket(r):
    key = F.col("customer_id")
    return r.customers.select(
        key, scalars.hash_bucket(key, 2).alias("two"), scalars.hash_bucket(key, 10000).alias("many")
    )


@query("fn_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS chars FROM documents")
def fn_length(r):
    return r.table("documents").select("doc_id", F.length("text").alias("chars"))


@query(
    "fn_casts",
    oracle(f"""
    SELECT order_id, CAST({TS} AS DATE) AS as_date, CAST(CAST({TS} AS DATE) AS TIMESTAMP) AS as_timestamp,
           CAST(order_id AS VARCHAR) AS as_text, CAST(order_id AS INTEGER) AS as_int,
           CAST(CAST(order_id AS DECIMAL(18,2)) AS DOUBLE) AS as_decimal FROM r_orders"""),
)
def fn_casts(r):
    day = F.col(TS).cast("date")
    return r.orders.select(
        "order_id",
        day.alias("as_date"),
        day.cast("timestamp_ntz").alias("as_timestamp"),
        F.col("order_id").cast("string").alias("as_text"),
        F.col("order_id").cast("int").alias("as_int"),
        F.col("order_id").cast("decimal(18,2)").alias("as_decimal"),
    )


@query(
    "fn_current",
    oracle(f"""
    SELECT order_id, CAST(datediff('day', CAST({TS} AS DATE), DATE '2001-09-01') AS INTEGER) AS age_days,
           DATE '2001-09-01' AS run_date FROM r_orders"""),
)
def fn_current(r):
    today = dates.as_of(dt.date(2001, 9, 1))
    return r.orders.select("order_id", F.datediff(today, F.col(TS)).alias("age_days"), today.alias("run_date"))


@query(
    "fn_beta_moments",
    oracle("""
    SELECT variant_id, period_date, round(a / (a + b), 9) AS mean,
           round(a * b / ((a + b) * (a + b) * (a + b + 1)), 9) AS var,
           round(sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 9) AS std
    FROM (SELECT variant_id, period_date, CAST(alpha_value AS DOUBLE) AS a, CAST(beta_value AS DOUBLE) AS b
          FROM store WHERE value_type = 'posterior')"""),
)
def fn_beta_moments(r):
    a, b = F.col("alpha_value").cast("double"), F.col("beta_value").cast("double")
    return (
        stored_chain(r)
        .where(F.col("value_type") == "posterior")
        .select(
            "variant_id",
            "period_date",
            F.round(scalars.beta_mean(a, b), 9).alias("mean"),
            F.round(scalars.beta_var(a, b), 9).alias("var"),
            F.round(scalars.beta_std(a, b), 9).alias("std"),
        )
    )


@query(
    "fn_period_from_date",
    oracle(f"""
    SELECT order_id, CAST(year({TS}) AS INTEGER) AS period_year, CAST(month({TS}) AS INTEGER) AS period_month,
           strftime({TS}, '%Y-%m') AS period_label FROM r_orders"""),
)
def fn_period_from_date(r):
    return project(r.orders, {"order_id": F.col("order_id"), **dates.period(F.col(TS))})


@query(
    "fn_money_format",
    oracle("""
    SELECT seller_id, format('{:,.2f}', CAST(revenue AS DOUBLE)) AS revenue, format('{:,}', n) AS lines,
           format('{:,.1f}%', CAST(CAST(round(share, 1) AS DECIMAL(20,1)) AS DOUBLE)) AS freight_share
    FROM (SELECT seller_id, sum(price) AS revenue, count(*) * 1000 AS n,
                 CAST(sum(freight_value) * 100 // 100000 AS DECIMAL(20,2)) / 100 * 1.0::DECIMAL(2,1) AS share
          FROM r_items GROUP BY seller_id)"""),
)
def fn_money_format(r):
    grouped = r.items.groupBy("seller_id").agg(
        F.sum("price").alias("v"),
        (F.count(F.lit(1)) * 1000).alias("n"),
        F.floor(F.sum("freight_value") * 100 / 100000).cast("decimal(20,2)").alias("s"),
    )
    return grouped.select(
        "seller_id",
        scalars.money(F.col("v")).alias("revenue"),
        scalars.whole(F.col("n")).alias("lines"),
        scalars.pct(F.round(F.col("s") / 100, 1)).alias("freight_share"),
    )
