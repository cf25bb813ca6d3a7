"""The loads as a user runs them: the whole star at once, in two batches that overlap, and a month on top."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork import catalog
from tillwork.operators.pages import distinct_counts, distinct_pages
from tillwork.operators.quality import star_report
from tillwork.plans import dims
from tillwork.plans.monthly import MonthResult, run_month
from tillwork.plans.rollup import SalesRollup
from tillwork.plans.warehouse import Warehouse, bulk_load, load_batch
from tillwork.session import work_path
from tillwork.sources.files import empty_table
from tillwork.sources.retail import Retail
from tillwork.suite.parts import PARTS, date_key, oracle, per
from tillwork.suite.registry import query
from tillwork.suite.reports import full_sql

FIRST_RUN, SECOND_RUN = dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1)
TEST_ID = dims.COUPON_TEST["test_id"]

_loaded: dict[tuple, Warehouse] = {}


def _tables(r: Retail) -> dict[str, DataFrame]:
    return {
        "customers": r.customers, "orders": r.orders_with_delivery, "order_items": r.items,
        "order_payments": r.payments, "order_reviews": r.reviews, "products": r.products, "sellers": r.sellers,
    }


def loaded(r: Retail) -> Warehouse:
    """The star of the folder after a bulk load, which is paid once a session."""
    key = (r.spark.sparkContext.applicationId, r.sf_dir, "bulk")
    if key not in _loaded:
        _loaded[key] = bulk_load(r.spark, _tables(r), work_path(r.spark, "bulk"), FIRST_RUN)
    return _loaded[key]


def loaded_twice(r: Retail) -> Warehouse:
    """The star after the orders before 1998, then those from December 1997 on."""
    key = (r.spark.sparkContext.applicationId, r.sf_dir, "batches")
    if key not in _loaded:
        wh = Warehouse(r.spark, work_path(r.spark, "batches"))
        load_batch(wh, _tables(r), FIRST_RUN, until=dt.date(1998, 1, 1))
        _loaded[key] = load_batch(wh, _tables(r), SECOND_RUN, since=dt.date(1997, 12, 1))
    return _loaded[key]


CUSTOMER_SQL = oracle("""
    SELECT customer_key, CAST(customer_id AS VARCHAR) AS customer_id, customer_state, customer_segment, last_order_date,
           total_orders, CAST(lifetime_value AS DOUBLE) AS lifetime_value, TIMESTAMP '{ts}' AS updated_at FROM d_customer""")


def _customers(wh: Warehouse) -> DataFrame:
    return wh.read("dim_customer").select(
        "customer_key", "customer_id", "customer_state", "customer_segment", "last_order_date", "total_orders",
        "lifetime_value", "updated_at",
    )


@query("bulk_load_dim_customer", CUSTOMER_SQL.replace("{ts}", "2020-01-01"))
def bulk_load_dim_customer(r):
    return _customers(loaded(r))


@query("load_two_batches_dim_customer", CUSTOMER_SQL.replace("{ts}", "2020-02-01"))
def load_two_batches_dim_customer(r):
    return _customers(loaded_twice(r))


@query(
    "bulk_load_dim_product",
    oracle("""
    SELECT product_key, CAST(product_id AS VARCHAR) AS product_id, product_category_name, is_heavy_item, is_large_item
    FROM d_product"""),
)
def bulk_load_dim_product(r):
    return loaded(r).read("dim_product").select(
        "product_key", "product_id", "product_category_name", "is_heavy_item", "is_large_item"
    )


@query(
    "bulk_load_dim_seller",
    oracle("""
    SELECT d.seller_key, CAST(seller_id AS VARCHAR) AS seller_id, seller_segment, total_sales,
           CAST(total_revenue AS DOUBLE) AS total_revenue,
           CASE WHEN n > 0 THEN CAST((200 * s + n) // (2 * n) AS DOUBLE) / 100 END AS avg_rating
    FROM d_seller d LEFT JOIN (SELECT seller_key, sum(review_score) AS s, count(review_score) AS n FROM f_reviews
                               GROUP BY seller_key) r ON d.seller_key = r.seller_key"""),
)
def bulk_load_dim_seller(r):
    """With the mean score of the reviews, which the load adds once these are stored."""
    return loaded(r).read("dim_seller").select(
        "seller_key", "seller_id", "seller_segment", "total_sales", "total_revenue", "avg_rating"
    )


# orders bought at the same time are ordered by their stored identifier, which is a string
BY_TEXT = {"f_sales": PARTS["f_sales"].replace("order_purchase_timestamp, order_id)", "order_purchase_timestamp, CAST(order_id AS VARCHAR))")}
SALES_SQL = oracle(
    """
    SELECT customer_key, product_key, seller_key, order_date_key, CAST(order_id AS VARCHAR) AS order_id, order_item_id,
           CAST(total_value AS DOUBLE) AS total_value, is_first_purchase, is_repeat_customer FROM f_sales""",
    BY_TEXT,
)


def _sales(wh: Warehouse) -> DataFrame:
    return wh.read("fact_sales").select(
        "customer_key", "product_key", "seller_key", "order_date_key", "order_id", "order_item_id", "total_value",
        "is_first_purchase", "is_repeat_customer",
    )


@query("bulk_load_fact_sales", SALES_SQL)
def bulk_load_fact_sales(r):
    return _sales(loaded(r))


@query("load_two_batches", SALES_SQL)
def load_two_batches(r):
    """December is in both batches, and comes in once."""
    return _sales(loaded_twice(r))


def rolled_up(r: Retail) -> SalesRollup:
    """The totals of the star of two batches; months that are summed up already are not read."""
    rollup = SalesRollup(loaded_twice(r))
    rollup.refresh()
    return rollup


@query("rollup_all_months", oracle(full_sql("year, month")))
def rollup_all_months(r):
    """Every month from stored totals and bitmap pages of customers."""
    return rolled_up(r).by_month()


@query("rollup_half_year", oracle(full_sql(where="WHERE year * 100 + month BETWEEN 199710 AND 199803")))
def rollup_half_year(r):
    """Six months on both sides of the seam of the batches: a customer of several counts once."""
    return rolled_up(r).over(199710, 199803)


ORDERS_SQL = oracle(f"""
    SELECT customer_key, {date_key('order_purchase_timestamp')} AS purchase_date_key, CAST(o.order_id AS VARCHAR) AS order_id,
           CAST(coalesce(v, 0) AS DOUBLE) AS total_order_value, coalesce(n, 0) AS item_count, coalesce(u, 0) AS unique_sellers,
           CAST(CASE order_status WHEN 'created' THEN 1 WHEN 'processing' THEN 3 WHEN 'delivered' THEN 5 END AS BIGINT) AS status_key,
           {date_key('order_approved_at')} AS approved_date_key,
           {date_key('order_delivered_customer_date')} AS delivered_date_key,
           {date_key('order_estimated_delivery_date')} AS estimated_delivery_date_key
    FROM r_delivery o JOIN k_customer k ON o.customer_id = k.customer_id
    LEFT JOIN (SELECT order_id, sum(price + freight_value) AS v, count(*) AS n, count(DISTINCT seller_id) AS u
               FROM r_items GROUP BY order_id) t ON o.order_id = t.order_id""")


def _orders(wh: Warehouse) -> DataFrame:
    return wh.read("fact_orders").select(
        "customer_key", "purchase_date_key", "order_id", "total_order_value", "item_count", "unique_sellers",
        "status_key", "approved_date_key", "delivered_date_key", "estimated_delivery_date_key",
    )


@query("bulk_load_fact_orders", ORDERS_SQL)
def bulk_load_fact_orders(r):
    """With the measures that the table declares beyond the built ones."""
    return _orders(loaded(r))


@query("load_two_batches_fact_orders", ORDERS_SQL)
def load_two_batches_fact_orders(r):
    return _orders(loaded_twice(r))


@query(
    "bulk_load_fact_payments",
    oracle(f"""
    SELECT customer_key, {date_key('order_purchase_timestamp')} AS payment_date_key, CAST(p.order_id AS VARCHAR) AS order_id,
           payment_sequential, payment_type, CAST(payment_value AS DOUBLE) AS payment_value,
           payment_installments > 1 AS is_installment_payment, payment_type = 'credit_card' AS is_credit_card
    FROM r_payments p JOIN r_orders o ON p.order_id = o.order_id JOIN k_customer k ON o.customer_id = k.customer_id"""),
)
def bulk_load_fact_payments(r):
    return loaded(r).read("fact_payments").select(
        "customer_key", "payment_date_key", "order_id", "payment_sequential", "payment_type", "payment_value",
        "is_installment_payment", "is_credit_card",
    )


REVIEWS_SQL = oracle("""
    SELECT customer_key, product_key, seller_key, review_date_key, CAST(review_id AS VARCHAR) AS review_id,
           CAST(order_id AS VARCHAR) AS order_id, review_score, has_comment, comment_length FROM f_reviews""")


def _reviews(wh: Warehouse) -> DataFrame:
    return wh.read("fact_reviews").select(
        "customer_key", "product_key", "seller_key", "review_date_key", "review_id", "order_id", "review_score",
        "has_comment", "comment_length",
    )


@query("bulk_load_fact_reviews", REVIEWS_SQL)
def bulk_load_fact_reviews(r):
    return _reviews(loaded(r))


@query("load_two_batches_fact_reviews", REVIEWS_SQL)
def load_two_batches_fact_reviews(r):
    return _reviews(loaded_twice(r))


@query(
    "bulk_load_fact_events",
    oracle("""
    SELECT customer_key, CAST(test_key AS BIGINT) AS test_key, CAST(variant_key AS BIGINT) AS variant_key, event_date_key,
           CAST(conversion_value AS DOUBLE) AS conversion_value, is_conversion FROM events_x"""),
)
def bulk_load_fact_events(r):
    return loaded(r).read("fact_ab_test_events").select(
        "customer_key", "test_key", "variant_key", "event_date_key", "conversion_value", "is_conversion"
    )


NUMBERED = {"fact_sales": "sale_key", "fact_orders": "order_key", "fact_payments": "payment_key", "fact_reviews": "review_key"}


@query(
    "load_two_batches_keys",
    oracle(
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, n AS rows, n AS keys, CAST(1 AS BIGINT) AS least, n AS most FROM (SELECT count(*) AS n FROM {source})"
            for name, source in zip(NUMBERED, ["f_sales", "r_orders", "r_payments", "f_reviews"], strict=True)
        )
    ),
)
def load_two_batches_keys(r):
    """The generated numbers go on from batch to batch, each given once."""
    wh = loaded_twice(r)
    # dense numbers are counted exactly by their bitmap pages, a few KB for each 32,768 of them
    parts = [
        wh.read(name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
            F.first(distinct_counts(distinct_pages(wh.read(name), key), "n").scalar()).alias("keys"),
            F.min(key).alias("least"), F.max(key).alias("most"),
        )
        for name, key in NUMBERED.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def last_month(r: Retail) -> MonthResult:
    """The month of the last order, run on the bulk load with an empty prior store."""
    key = (r.spark.sparkContext.applicationId, r.sf_dir, "month")
    if key not in _loaded:
        wh = loaded(r)
        period = dims.purchase_range(r.orders).first().end_date.replace(day=1)
        store = empty_table(r.spark, catalog.ANALYTICS["bayesian_priors_store"])
        _loaded[key] = run_month(wh, store, period, TEST_ID, FIRST_RUN)
    return _loaded[key]


LAST = "(SELECT date_trunc('month', max(order_purchase_timestamp)) FROM r_orders)"


@query(
    "run_month_store",
    oracle(f"""
    WITH per_variant AS (
        SELECT variant_key, count(*) AS n, count(*) FILTER (WHERE c) AS good
        FROM (SELECT variant_key, customer_key, bool_or(is_conversion) AS c FROM events_x GROUP BY 1, 2) GROUP BY 1)
    SELECT prior_id, variant_id, period_date, value_type, alpha_value, beta_value, data_points, conversions FROM (
        SELECT v.variant_id, CAST({LAST} + add AS DATE) AS period_date, kind AS value_type, CAST(1 + good AS DOUBLE) AS alpha_value,
               CAST(1 + n - good AS DOUBLE) AS beta_value, n AS data_points, good AS conversions,
               place + row_number() OVER (PARTITION BY kind ORDER BY
                   CAST('0x' || substr(md5(concat_ws(chr(31), 'coupon_promo_v1', variant_id,
                        strftime({LAST} + add, '%Y-%m-%d'), kind)), 1, 8) AS BIGINT) % 4096, variant_id) AS prior_id
        FROM per_variant p JOIN variants v ON p.variant_key = v.variant_key
        CROSS JOIN (VALUES ('posterior', INTERVAL 0 MONTH, CAST(0 AS BIGINT)), ('prior', INTERVAL 1 MONTH, CAST(2 AS BIGINT))) AS k(kind, add, place))"""),
)
def run_month_store(r):
    """The posterior of the month and the prior of the next."""
    return last_month(r).store.select(
        "prior_id", "variant_id", "period_date", "value_type", "alpha_value", "beta_value", "data_points", "conversions"
    )


@query(
    "run_month_summary",
    oracle(f"""
    SELECT count(DISTINCT order_id) AS total_orders, count(*) AS total_line_items, CAST(sum(total_value) AS DOUBLE) AS total_revenue,
           {per('sum(total_value)', 'count(DISTINCT order_id)')} AS avg_order_value
    FROM f_sales WHERE order_date_key >= CAST(strftime({LAST}, '%Y%m%d') AS INTEGER)"""),
)
def run_month_summary(r):
    return last_month(r).summary.select("total_orders", "total_line_items", "total_revenue", "avg_order_value")


def _names() -> list[str]:
    """Every declared constraint of the 13 tables."""
    out = [f"not_null:{t}.{c}" for t in catalog.ANALYTICS for c in catalog.required_columns(t)]
    out += [f"unique:{t}({','.join(k)})" for t, keys in catalog.UNIQUE_KEYS.items() for k in keys]
    return out + [f"fk:{child}.{fk}" for child, fk, _, _ in catalog.FOREIGN_KEYS]


LOST = "customer_key % 7 = 0"
OF_LOST = f"JOIN r_orders o ON x.order_id = o.order_id JOIN k_customer k ON o.customer_id = k.customer_id WHERE {LOST}"
BROKEN = {
    "fk:fact_sales.customer_key": f"SELECT count(*) FROM f_sales WHERE {LOST}",
    "fk:fact_orders.customer_key": f"SELECT count(*) FROM r_orders o JOIN k_customer k ON o.customer_id = k.customer_id WHERE {LOST}",
    "fk:fact_payments.customer_key": f"SELECT count(*) FROM r_payments x {OF_LOST}",
    "fk:fact_reviews.customer_key": f"SELECT count(*) FROM f_reviews WHERE {LOST}",
    "fk:fact_ab_test_events.customer_key": f"SELECT count(*) FROM events_x WHERE {LOST}",
    "unique:dim_product(product_key)": "SELECT count(*) FROM k_product WHERE product_id % 5 = 0",
    "unique:dim_product(product_id)": "SELECT count(*) FROM k_product WHERE product_id % 5 = 0",
    "not_null:dim_seller.seller_id": "SELECT count(*) FROM k_seller WHERE seller_id % 3 = 0",
}


@query(
    "dq_star_report_all",
    oracle(
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS check_name, 'fail' AS severity, CAST(v AS BIGINT) AS violations, v = 0 AS passed "
            f"FROM (SELECT ({BROKEN.get(name, 'SELECT 0')}) AS v)"
            for name in _names()
        )
    ),
)
def dq_star_report_all(r):
    """All 13 tables as loaded, but without some customers, with some products twice and some sellers without id."""
    wh = loaded(r)
    tables = {name: wh.read(name) for name in catalog.ANALYTICS if name != "bayesian_priors_store"}
    products, sellers = tables["dim_product"], tables["dim_seller"]
    tables["dim_customer"] = tables["dim_customer"].where("customer_key % 7 <> 0")
    tables["dim_product"] = products.unionByName(products.where("cast(product_id as bigint) % 5 = 0"))
    kept = F.when(F.col("seller_id").cast("bigint") % 3 != 0, F.col("seller_id"))
    tables["dim_seller"] = sellers.withColumn("seller_id", kept)
    tables["bayesian_priors_store"] = last_month(r).store
    return star_report(tables)
