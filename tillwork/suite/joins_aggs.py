"""Joins, aggregations, windows, sorts and top-n."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.operators import aggregates as agg
from tillwork.operators import joins, windows
from tillwork.operators import relational as rel
from tillwork.operators.experiment import EVEN_SPLIT
from tillwork.operators.merge import surrogate_key
from tillwork.plans import report
from tillwork.plans.dims import build_ab_dims
from tillwork.plans.facts import build_fact_sales
from tillwork.sources.files import values_table
from tillwork.suite.basics import stored_chain
from tillwork.suite.parts import arm, oracle, pct
from tillwork.suite.registry import query
from tillwork.suite.star import stored_star


def customer_keys(r):
    return surrogate_key(r.customers.select("customer_id", "customer_state"), "customer_id", "customer_key")


def product_keys(r):
    return surrogate_key(r.products.select("product_id", "product_category_name"), "product_id", "product_key")


def seller_keys(r):
    return surrogate_key(r.sellers.select("seller_id"), "seller_id", "seller_key")


def sales(r, orders=None):
    """Sales built from the raw tables, in one plan."""
    return build_fact_sales(
        r.items, r.orders if orders is None else orders, customer_keys(r), product_keys(r), seller_keys(r)
    )


# -- joins --------------------------------------------------------------------


@query(
    "join_inner_equi",
    oracle("""
    SELECT i.order_id, order_item_id, product_id, order_purchase_timestamp
    FROM r_items i JOIN r_orders o ON i.order_id = o.order_id"""),
)
def join_inner_equi(r):
    return joins.join(r.items, r.orders, "order_id").select(
        "order_id", "order_item_id", "product_id", "order_purchase_timestamp"
    )


@query(
    "join_star_multiway",
    oracle("SELECT customer_key, product_key, seller_key, order_id, order_item_id FROM f_sales"),
)
def join_star_multiway(r):
    dims = [
        (r.orders.select("order_id", "customer_id"), "order_id"),
        (customer_keys(r), "customer_id"),
        (product_keys(r), "product_id"),
        (seller_keys(r), "seller_id"),
    ]
    return joins.resolve_dims(r.items, dims).select(
        "customer_key", "product_key", "seller_key", "order_id", "order_item_id"
    )


@query(
    "join_left_outer",
    oracle("""
    SELECT o.order_id, i.product_id FROM r_orders o LEFT JOIN r_items i ON o.order_id = i.order_id"""),
)
def join_left_outer(r):
    """To the many side, whose hot keys a plain left join would leave in one task."""
    return joins.fan_out(r.orders, r.items, "order_id").select("order_id", "product_id")


@query(
    "join_left_preagg",
    oracle("""
    SELECT o.order_id, coalesce(n, 0) AS item_count, CAST(coalesce(v, 0) AS DOUBLE) AS total_value
    FROM r_orders o LEFT JOIN (SELECT order_id, count(*) AS n, sum(price + freight_value) AS v
                               FROM r_items GROUP BY order_id) t ON o.order_id = t.order_id"""),
)
def join_left_preagg(r):
    totals = agg.order_totals(r.items, "order_id", "price", "freight_value")
    joined = joins.left_join_agg(r.orders.select("order_id"), totals, "order_id", ["item_count", "total_value"])
    return joined.select("order_id", "item_count", "total_value")


@query(
    "join_left_ranked",
    oracle("""
    SELECT i.order_id, order_item_id, nth AS customer_order_rank FROM r_items i LEFT JOIN (
        SELECT order_id, row_number() OVER (PARTITION BY customer_id
               ORDER BY order_purchase_timestamp, order_id) AS nth FROM r_orders) o
      ON i.order_id = o.order_id"""),
)
def join_left_ranked(r):
    ranked = windows.order_rank(r.orders, "customer_id", "order_purchase_timestamp", "order_id")
    return joins.left_join_ranked(
        r.items.select("order_id", "order_item_id"), ranked.select("order_id", "customer_order_rank"), "order_id"
    )


@query("join_cross", oracle("SELECT customer_id, 'coupon_promo_v1' AS test_id FROM r_customers"))
def join_cross(r):
    tests, _ = build_ab_dims(r.spark)
    return joins.attach_one_row(r.customers.select("customer_id"), tests.select("test_id"))


@query(
    "join_computed_predicate",
    oracle(f"""
    SELECT customer_id, variant_key, variant_id FROM r_customers JOIN variants ON variant_id = {arm('customer_id')}"""),
)
def join_computed_predicate(r):
    _, variants = build_ab_dims(r.spark)
    arms = variants.select(F.col("variant_key").cast("int").alias("variant_key"), "variant_id")
    return joins.join_bucket(r.customers.select("customer_id"), arms, F.col("customer_id"), EVEN_SPLIT)


@query(
    "anti_join_not_exists",
    oracle("""
    SELECT customer_id, customer_state FROM r_customers c WHERE NOT EXISTS (
        SELECT 1 FROM r_orders o WHERE o.customer_id = c.customer_id
        AND o.order_purchase_timestamp >= TIMESTAMP '1997-01-01' AND o.order_purchase_timestamp < TIMESTAMP '1998-01-01')"""),
)
def anti_join_not_exists(r):
    year = r.orders.where(F.year("order_purchase_timestamp") == 1997)
    return joins.not_exists(r.customers, year, ["customer_id"]).select("customer_id", "customer_state")


@query(
    "anti_join_left_null",
    """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders
    LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey
    WHERE c_custkey IS NULL""",
)
def anti_join_left_null(r):
    """Parents of one market segment are taken away, so that orphans exist."""
    parents = r.table("customer").where(F.col("c_mktsegment") != "BUILDING")
    return joins.orphans(r.orders.select("order_id", "customer_id"), "customer_id", parents, "c_custkey")


@query(
    "join_fanout_many",
    oracle("""
    SELECT r.review_id, r.order_id, i.product_id FROM r_reviews r LEFT JOIN r_items i ON r.order_id = i.order_id"""),
)
def join_fanout_many(r):
    return joins.fan_out(
        r.reviews.select("review_id", "order_id"), r.items.select("order_id", "product_id"), "order_id"
    )


def two_tests(r):
    """Two tests whose variants share their ids."""
    tests = values_table(
        r.spark,
        [(1, "coupon_promo_v1", "Coupon"), (2, "banner_v1", "Banner")],
        "test_key bigint, test_id string, test_name string",
    )
    variants = values_table(
        r.spark,
        [
            (1, 1, "A", "10% Discount", True),
            (2, 1, "B", "Free Shipping + 5%", False),
            (3, 2, "A", "Old banner", True),
            (4, 2, "B", "New banner", False),
        ],
        "variant_key bigint, test_key bigint, variant_id string, variant_name string, is_control boolean",
    )
    return tests, variants


@query(
    "join_three_way_report",
    oracle("""
    SELECT v.variant_name, s.variant_id, s.period_date, s.value_type, s.data_points
    FROM store s JOIN variants2 v ON s.variant_id = v.variant_id"""),
)
def join_three_way_report(r):
    """Matching on the variant id alone: the second test multiplies the rows."""
    tests, variants = two_tests(r)
    joined = joins.join_test_variant(stored_chain(r), variants, tests, match_test=False)
    return joined.select("variant_name", "variant_id", "period_date", "value_type", "data_points")


@query(
    "join_three_way_matched",
    oracle("""
    SELECT v.variant_name, s.variant_id, s.period_date, s.value_type, s.data_points
    FROM store s JOIN variants2 v ON s.variant_id = v.variant_id AND s.test_id = v.test_id"""),
)
def join_three_way_matched(r):
    tests, variants = two_tests(r)
    joined = joins.join_test_variant(stored_chain(r), variants, tests)
    return joined.select("variant_name", "variant_id", "period_date", "value_type", "data_points")


# -- aggregations -------------------------------------------------------------


@query("agg_count_filtered", oracle("SELECT count(*) AS n FROM r_items WHERE freight_value = 0"))
def agg_count_filtered(r):
    return agg.count_where(r.items, F.col("freight_value") == 0)


@query(
    "agg_count_distinct",
    oracle("""
    SELECT count(DISTINCT order_id) AS n_order_id, count(DISTINCT product_id) AS n_product_id FROM r_items"""),
)
def agg_count_distinct(r):
    return agg.count_distinct(r.items, ["order_id", "product_id"])


@query(
    "agg_sum_avg_coalesce",
    oracle("""
    SELECT CAST(sum(price) AS DOUBLE) AS total, CAST(sum(price) AS DOUBLE) / count(price) AS mean FROM r_items"""),
)
def agg_sum_avg_coalesce(r):
    return agg.sum_avg_or_zero(r.items, "price")


@query(
    "agg_sum_avg_coalesce_empty",
    oracle("SELECT CAST(coalesce(sum(price), 0) AS DOUBLE) AS total, CAST(0 AS DOUBLE) AS mean FROM r_items WHERE price < 0"),
)
def agg_sum_avg_coalesce_empty(r):
    return agg.sum_avg_or_zero(r.items.where(F.col("price") < 0), "price")


@query(
    "agg_min_max_date",
    oracle("""
    SELECT customer_id, min(CAST(order_purchase_timestamp AS DATE)) AS min_date,
           max(CAST(order_purchase_timestamp AS DATE)) AS max_date FROM r_orders GROUP BY customer_id
    UNION ALL
    SELECT NULL, min(CAST(order_purchase_timestamp AS DATE)), max(CAST(order_purchase_timestamp AS DATE)) FROM r_orders"""),
)
def agg_min_max_date(r):
    grouped = agg.min_max_date(r.orders, "order_purchase_timestamp", ["customer_id"])
    overall = agg.min_max_date(r.orders, "order_purchase_timestamp")
    return grouped.unionByName(overall, allowMissingColumns=True)


@query(
    "agg_conditional_sum",
    oracle("""
    SELECT payment_type, CAST(sum(CASE WHEN payment_installments > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_flag
    FROM r_payments GROUP BY payment_type"""),
)
def agg_conditional_sum(r):
    return agg.count_flag(r.payments, F.col("payment_installments") > 1, ["payment_type"])


@query(
    "agg_group_single",
    oracle("""
    SELECT seller_id, count(*) AS n, CAST(sum(price) AS DOUBLE) AS revenue, min(shipping_limit_date) AS first_ship
    FROM r_items GROUP BY seller_id"""),
)
def agg_group_single(r):
    return agg.agg_by(
        r.items,
        "seller_id",
        {"n": F.count(F.lit(1)), "revenue": F.sum("price"), "first_ship": F.min("shipping_limit_date")},
    )


@query(
    "agg_group_multi",
    oracle("""
    SELECT payment_type, payment_installments, count(*) AS n, CAST(sum(payment_value) AS DOUBLE) AS paid
    FROM r_payments GROUP BY payment_type, payment_installments"""),
)
def agg_group_multi(r):
    return agg.agg_by(
        r.payments,
        ["payment_type", "payment_installments"],
        {"n": F.count(F.lit(1)), "paid": F.sum("payment_value")},
    )


@query(
    "agg_rate_pct",
    oracle(f"""
    SELECT payment_type, {pct('count(*) FILTER (WHERE payment_installments > 3)', 'count(*)')} AS rate
    FROM r_payments GROUP BY payment_type"""),
)
def agg_rate_pct(r):
    from tillwork.functions.scalars import rate_pct

    part = F.count_if(F.col("payment_installments") > 3)
    return agg.agg_by(r.payments, "payment_type", {"rate": rate_pct(part, F.count(F.lit(1)))})


@query(
    "agg_null_profile",
    oracle("""
    UNPIVOT (SELECT count(*) - count(product_id) AS product_id, count(*) - count(product_category_name) AS product_category_name,
             count(*) - count(product_name_length) AS product_name_length,
             count(*) - count(product_description_length) AS product_description_length,
             count(*) - count(product_photos_qty) AS product_photos_qty,
             count(*) - count(product_weight_g) AS product_weight_g, count(*) - count(product_length_cm) AS product_length_cm,
             count(*) - count(product_height_cm) AS product_height_cm, count(*) - count(product_width_cm) AS product_width_cm
             FROM r_products) ON COLUMNS(*) INTO NAME "column" VALUE nulls"""),
)
def agg_null_profile(r):
    return agg.null_profile(r.products)


@query(
    "agg_value_counts",
    oracle("SELECT product_category_name, count(*) AS n FROM r_products GROUP BY 1 ORDER BY n DESC, 1"),
)
def agg_value_counts(r):
    return agg.value_counts(r.products, "product_category_name")


@query(
    "agg_dupe_values",
    oracle("SELECT order_id, count(*) AS n FROM r_items GROUP BY order_id HAVING count(*) > 1"),
)
def agg_dupe_values(r):
    return agg.dupe_values(r.items, "order_id")


@query(
    "agg_has_dupes",
    oracle("""
    SELECT (SELECT count(*) <> count(DISTINCT customer_id) FROM r_customers) AS customers,
           (SELECT count(*) <> count(DISTINCT order_id) FROM r_items) AS items"""),
)
def agg_has_dupes(r):
    first = agg.has_dupes(r.customers, "customer_id").withColumnRenamed("has_dupes", "customers")
    second = agg.has_dupes(r.items, "order_id").withColumnRenamed("has_dupes", "items")
    return joins.attach_one_row(first, second)


@query(
    "distinct_rows",
    oracle("SELECT DISTINCT payment_type, payment_installments, payment_sequential FROM r_payments"),
)
def distinct_rows(r):
    return agg.distinct(r.payments.select("payment_type", "payment_installments", "payment_sequential"))


@query("distinct_values", oracle("SELECT DISTINCT review_score FROM r_reviews"))
def distinct_values(r):
    """NULL stays a value."""
    return agg.distinct_values(r.reviews, "review_score")


@query(
    "agg_count_sum_expr",
    oracle("""
    SELECT order_id, count(*) AS item_count, CAST(sum(price + freight_value) AS DOUBLE) AS total_value,
           CAST(sum(freight_value) AS DOUBLE) AS total_freight FROM r_items GROUP BY order_id"""),
)
def agg_count_sum_expr(r):
    return agg.order_totals(r.items, "order_id", "price", "freight_value")


# -- windows ------------------------------------------------------------------

RANKED = """
    SELECT order_id, customer_id, row_number() OVER (PARTITION BY customer_id
           ORDER BY order_purchase_timestamp, order_id) AS customer_order_rank FROM r_orders"""


@query("window_order_rank", oracle(RANKED))
def window_order_rank(r):
    ranked = windows.order_rank(r.orders, "customer_id", "order_purchase_timestamp", "order_id")
    return ranked.select("order_id", "customer_id", "customer_order_rank")


@query("window_order_rank_hot", oracle(RANKED))
def window_order_rank_hot(r):
    """The same result when customers with more than ten orders count as hot."""
    ranked = windows.order_rank(r.orders, "customer_id", "order_purchase_timestamp", "order_id")
    return ranked.select("order_id", "customer_id", "customer_order_rank")


@query(
    "first_repeat_flags",
    oracle(f"""
    SELECT order_id, customer_order_rank = 1 AS is_first_purchase, customer_order_rank > 1 AS is_repeat_customer
    FROM ({RANKED})"""),
)
def first_repeat_flags(r):
    ranked = windows.order_rank(r.orders, "customer_id", "order_purchase_timestamp", "order_id")
    flags = windows.first_repeat(F.col("customer_order_rank"))
    return rel.project(ranked, {"order_id": F.col("order_id"), **flags})


@query(
    "first_order_per_customer",
    oracle(f"SELECT order_id FROM ({RANKED}) WHERE customer_order_rank = 1"),
)
def first_order_per_customer(r):
    return windows.first_orders(r.orders, "customer_id", "order_purchase_timestamp", "order_id")


@query(
    "dupe_rows_keep_first",
    """
    SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_partkey AS part, l_extendedprice AS price
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                 ORDER BY l_partkey, l_extendedprice) AS nth FROM lineitem) WHERE nth > 1""",
)
def dupe_rows_keep_first(r):
    rows = r.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_partkey").alias("part"),
        F.col("l_extendedprice").alias("price"),
    )
    return windows.dupe_rows(rows, ["order_id", "payment_sequential"], ["part", "price"])


@query(
    "latest_posterior_per_variant",
    oracle("""
    SELECT variant_id, period_date, CAST(alpha_value AS DOUBLE) AS alpha_value, CAST(beta_value AS DOUBLE) AS beta_value
    FROM store WHERE value_type = 'posterior'
    QUALIFY row_number() OVER (PARTITION BY test_id, variant_id ORDER BY period_date DESC) = 1"""),
)
def latest_posterior_per_variant(r):
    rows = stored_chain(r).where(F.col("value_type") == "posterior")
    latest = windows.latest_per(rows, ["test_id", "variant_id"], "period_date")
    return latest.select("variant_id", "period_date", "alpha_value", "beta_value")


# -- sorts and top-n ----------------------------------------------------------


@query(
    "sort_multi_key",
    oracle("""
    SELECT seller_id, CAST(price AS DOUBLE) AS price, order_id FROM r_items ORDER BY seller_id, price DESC, order_id"""),
)
def sort_multi_key(r):
    return rel.sort(r.items.select("seller_id", "price", "order_id"), ["seller_id", F.desc("price"), "order_id"])


@query(
    "sort_desc_limit",
    oracle("""
    SELECT variant_id, period_date, data_points, conversions FROM store WHERE value_type = 'posterior'
    ORDER BY period_date DESC, variant_id LIMIT 2"""),
)
def sort_desc_limit(r):
    rows = stored_chain(r).where(F.col("value_type") == "posterior")
    top = rel.sort_limit(rows, [F.desc("period_date"), "variant_id"], 2)
    return top.select("variant_id", "period_date", "data_points", "conversions")


TOP_CATEGORIES = oracle("""
    SELECT product_category_name, count(*) AS items, CAST(sum(total_value) AS DOUBLE) AS revenue,
           CAST(row_number() OVER (ORDER BY sum(total_value) DESC, product_category_name) AS INTEGER) AS rank
    FROM f_sales s JOIN d_product p ON s.product_key = p.product_key
    GROUP BY product_category_name ORDER BY rank LIMIT 10""")
TOP_STATES = oracle("""
    SELECT customer_state, count(DISTINCT s.customer_key) AS customers, count(DISTINCT order_id) AS orders,
           CAST(sum(total_value) AS DOUBLE) AS revenue,
           CAST(row_number() OVER (ORDER BY sum(total_value) DESC, customer_state) AS INTEGER) AS rank
    FROM f_sales s JOIN d_customer c ON s.customer_key = c.customer_key
    GROUP BY customer_state ORDER BY rank LIMIT 10""")


@query("topk_categories", TOP_CATEGORIES)
def topk_categories(r):
    return report.top_categories(sales(r), product_keys(r))


@query("topk_states", TOP_STATES)
def topk_states(r):
    return report.top_states(sales(r), customer_keys(r))


@query("report_top_categories", TOP_CATEGORIES)
def report_top_categories(r):
    star = stored_star(r)
    return report.top_categories(star.read("fact_sales"), star.read("dim_product"))


@query("report_top_states", TOP_STATES)
def report_top_states(r):
    star = stored_star(r)
    return report.top_states(star.read("fact_sales"), star.read("dim_customer"))
