"""Common table expressions for the SQL checks.

They restate the retail mapping and the star tables in plain SQL, apart from
the Spark code, so that a slip in one does not hide in the other.
"""

from __future__ import annotations

import re


def date_key(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS INTEGER)"


def bucket(x: str, n: int) -> str:
    return f"(CAST('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 8) AS BIGINT) % {n})"


def half_up(num: str, den: str, scale: int) -> str:
    """num / den for whole numbers, rounded half up in integer arithmetic."""
    p = 10**scale
    return f"(CAST((2 * {p} * CAST({num} AS HUGEINT) + ({den})) // (2 * ({den})) AS DOUBLE) / {p})"


def pct(num: str, den: str) -> str:
    return half_up(f"100 * ({num})", den, 2)


def per(money: str, n: str) -> str:
    """Money divided by a count, to the cent."""
    cents = f"CAST(({money}) * 100 AS HUGEINT)"
    return f"(CAST((2 * {cents} + ({n})) // (2 * ({n})) AS DOUBLE) / 100)"


ARM = f"CASE WHEN {bucket('{id}', 10000)} < 5000 THEN 'A' ELSE 'B' END"


def arm(x: str) -> str:
    return ARM.replace("{id}", x)


def dense(key: str, ident: str, table: str) -> str:
    return (
        f"SELECT {ident}, row_number() OVER (ORDER BY {bucket(ident, 4096)}, {ident}) AS {key} FROM {table}"
    )


PARTS: dict[str, str] = {
    "places": """
        SELECT n_nationkey, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip, r_name AS city, n_name AS state
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "r_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_unique_id, zip AS customer_zip_code_prefix,
               city AS customer_city, state AS customer_state
        FROM customer JOIN places ON c_nationkey = n_nationkey""",
    "r_sellers": """
        SELECT s_suppkey AS seller_id, zip AS seller_zip_code_prefix, city AS seller_city, state AS seller_state
        FROM supplier JOIN places ON s_nationkey = n_nationkey""",
    "r_products": """
        SELECT p_partkey AS product_id, p_type AS product_category_name,
               CAST(length(p_name) AS INTEGER) AS product_name_length,
               CAST(length(p_brand) AS INTEGER) AS product_description_length,
               CAST(p_size % 5 AS INTEGER) AS product_photos_qty,
               CAST(nullif(p_size, 13) * 40 AS DECIMAL(12,2)) AS product_weight_g,
               CAST(nullif(p_size, 13) AS DECIMAL(12,2)) AS product_length_cm,
               CAST(p_retailprice AS DECIMAL(12,2)) AS product_height_cm,
               CAST('0.40' AS DECIMAL(12,2)) AS product_width_cm
        FROM part""",
    "r_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'processing' ELSE 'created' END
                 AS order_status,
               o_orderdate AS order_purchase_timestamp
        FROM orders""",
    "r_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
               CAST(round(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
                    AS DECIMAL(10,2)) AS freight_value
        FROM lineitem""",
    "r_payments": """
        SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
               CASE l_returnflag WHEN 'N' THEN 'credit_card' WHEN 'A' THEN 'boleto' ELSE 'voucher' END
                 AS payment_type,
               l_linenumber AS payment_installments,
               CAST(round(CAST(l_extendedprice AS DECIMAL(10,2))
                    * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(10,2)) AS payment_value
        FROM lineitem""",
    "r_reviews": """
        SELECT d.doc_id AS review_id, d.doc_id AS order_id, quality AS review_score,
               source AS review_comment_title, text AS review_comment_message,
               CAST(DATE '1998-01-01' + CAST(n_chars % 365 AS INTEGER) AS TIMESTAMP) AS review_creation_date
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "r_delivery": """
        SELECT o.order_id, customer_id, order_status, order_purchase_timestamp,
               order_purchase_timestamp + INTERVAL 1 DAY AS order_approved_at,
               first_ship AS order_delivered_carrier_date, last_ship AS order_delivered_customer_date,
               order_purchase_timestamp + INTERVAL 45 DAY AS order_estimated_delivery_date
        FROM r_orders o LEFT JOIN (
            SELECT l_orderkey AS order_id, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
            FROM lineitem GROUP BY l_orderkey) s ON o.order_id = s.order_id""",
    "k_customer": dense("customer_key", "customer_id", "r_customers"),
    "k_product": dense("product_key", "product_id", "r_products"),
    "k_seller": dense("seller_key", "seller_id", "r_sellers"),
    "d_customer": """
        SELECT k.customer_key, c.*,
               CASE WHEN n = 1 THEN 'new' WHEN n BETWEEN 2 AND 5 THEN 'returning'
                    WHEN spent > 1000 THEN 'vip' ELSE 'regular' END AS customer_segment,
               first_day AS first_order_date, last_day AS last_order_date,
               coalesce(n, 0) AS total_orders, coalesce(spent, 0) AS lifetime_value
        FROM r_customers c JOIN k_customer k ON c.customer_id = k.customer_id
        LEFT JOIN (SELECT customer_id, count(*) AS n, sum(payment_value) AS spent,
                          CAST(min(order_purchase_timestamp) AS DATE) AS first_day,
                          CAST(max(order_purchase_timestamp) AS DATE) AS last_day
                   FROM r_payments p JOIN r_orders o ON p.order_id = o.order_id
                   GROUP BY customer_id) s ON c.customer_id = s.customer_id""",
    "d_product": """
        SELECT k.product_key, p.*, product_weight_g > 1000 AS is_heavy_item,
               product_length_cm * product_height_cm * product_width_cm > 10000 AS is_large_item
        FROM r_products p JOIN k_product k ON p.product_id = k.product_id""",
    "d_seller": """
        SELECT k.seller_key, c.*,
               CASE WHEN n < 10 THEN 'small' WHEN n <= 100 THEN 'medium' ELSE 'large' END AS seller_segment,
               first_day AS first_sale_date, last_day AS last_sale_date,
               coalesce(n, 0) AS total_sales, coalesce(revenue, 0) AS total_revenue
        FROM r_sellers c JOIN k_seller k ON c.seller_id = k.seller_id
        LEFT JOIN (SELECT seller_id, count(*) AS n, sum(price + freight_value) AS revenue,
                          CAST(min(order_purchase_timestamp) AS DATE) AS first_day,
                          CAST(max(order_purchase_timestamp) AS DATE) AS last_day
                   FROM r_items i JOIN r_orders o ON i.order_id = o.order_id
                   GROUP BY seller_id) s ON c.seller_id = s.seller_id""",
    "f_sales": f"""
        SELECT customer_key, product_key, seller_key, {date_key('order_purchase_timestamp')} AS order_date_key,
               i.order_id, order_item_id, price, freight_value, price + freight_value AS total_value,
               nth = 1 AS is_first_purchase, nth > 1 AS is_repeat_customer
        FROM r_items i
        JOIN (SELECT *, row_number() OVER (PARTITION BY customer_id
                     ORDER BY order_purchase_timestamp, order_id) AS nth FROM r_orders) o
          ON i.order_id = o.order_id
        JOIN k_customer kc ON o.customer_id = kc.customer_id
        JOIN k_product kp ON i.product_id = kp.product_id
        JOIN k_seller ks ON i.seller_id = ks.seller_id""",
    "f_reviews": f"""
        SELECT customer_key, product_key, seller_key, {date_key('review_creation_date')} AS review_date_key,
               review_id, r.order_id, review_score, review_comment_title, review_comment_message,
               review_comment_message IS NOT NULL AND length(review_comment_message) > 0 AS has_comment,
               CAST(coalesce(length(review_comment_message), 0) AS INTEGER) AS comment_length
        FROM r_reviews r JOIN r_orders o ON r.order_id = o.order_id
        JOIN k_customer kc ON o.customer_id = kc.customer_id
        LEFT JOIN r_items i ON r.order_id = i.order_id
        LEFT JOIN k_product kp ON i.product_id = kp.product_id
        LEFT JOIN k_seller ks ON i.seller_id = ks.seller_id""",
    "variants": """
        SELECT * FROM (VALUES (1, 1, 'A', '10% Discount', TRUE), (2, 1, 'B', 'Free Shipping + 5%', FALSE))
          AS v(variant_key, test_key, variant_id, variant_name, is_control)""",
    # two tests that share variant ids
    "variants2": """
        SELECT * FROM (VALUES (1, 1, 'coupon_promo_v1', 'A', '10% Discount', TRUE),
                              (2, 1, 'coupon_promo_v1', 'B', 'Free Shipping + 5%', FALSE),
                              (3, 2, 'banner_v1', 'A', 'Old banner', TRUE),
                              (4, 2, 'banner_v1', 'B', 'New banner', FALSE))
          AS v(variant_key, test_key, test_id, variant_id, variant_name, is_control)""",
    "events_x": f"""
        SELECT c.customer_key, v.test_key, v.variant_key,
               {date_key('(SELECT max(order_purchase_timestamp) FROM r_orders)')} AS event_date_key,
               coalesce(s.total_value, 0) AS conversion_value,
               coalesce(CAST(s.total_value AS DOUBLE) > limit_value OR total_orders > 1, FALSE) AS is_conversion
        FROM d_customer c JOIN variants v ON v.variant_id = {arm('c.customer_id')}
        LEFT JOIN f_sales s ON c.customer_key = s.customer_key
        CROSS JOIN (SELECT CAST(sum(total_value) AS DOUBLE) / count(*) * 1.2::DOUBLE AS limit_value FROM f_sales)
        WHERE limit_value IS NOT NULL""",
    "trials": """
        SELECT user_id, CAST(ts AS DATE) AS event_day, bool_or(event_type = 'purchase') AS converted
        FROM events GROUP BY 1, 2 HAVING bool_or(event_type = 'view')""",
    "trial_counts": f"""
        SELECT 'coupon_promo_v1' AS test_id, {arm('user_id')} AS variant_id, event_day AS period_date,
               count(*) AS data_points, count(*) FILTER (WHERE converted) AS conversions
        FROM trials GROUP BY 1, 2, 3""",
    "chain": """
        SELECT test_id, variant_id, period_date, data_points, conversions,
               1 + sum(conversions) OVER w AS alpha_posterior,
               1 + sum(data_points - conversions) OVER w AS beta_posterior,
               1 + sum(conversions) OVER w - conversions AS alpha_prior,
               1 + sum(data_points - conversions) OVER w - (data_points - conversions) AS beta_prior
        FROM trial_counts WINDOW w AS (PARTITION BY test_id, variant_id ORDER BY period_date)""",
    "store": """
        SELECT test_id, variant_id, period_date, alpha_prior AS alpha_value, beta_prior AS beta_value,
               'prior' AS value_type, data_points, conversions FROM chain
        UNION ALL
        SELECT test_id, variant_id, period_date, alpha_posterior, beta_posterior,
               'posterior', data_points, conversions FROM chain""",
}

# the same experiment on the orders of one month, where outcomes differ by customer
MONTH_START, MONTH_END = "1997-03-01", "1997-04-01"
MONTH_ORDERS = (
    PARTS["r_orders"]
    + f"\n        WHERE o_orderdate >= TIMESTAMP '{MONTH_START}' AND o_orderdate < TIMESTAMP '{MONTH_END}'"
)


def oracle(body: str, replace: dict[str, str] | None = None) -> str:
    """``body`` with a WITH clause of every part it mentions, directly or not."""
    parts = {**PARTS, **(replace or {})}
    wanted: list[str] = []

    def need(text: str) -> None:
        for name in parts:
            if re.search(rf"\b{name}\b", text) and name not in wanted:
                need(parts[name])
                wanted.append(name)

    need(body)
    if not wanted:
        return body
    ctes = ",\n".join(f"{name} AS ({parts[name].strip()})" for name in wanted)
    body = body.strip()
    if body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body.removeprefix('WITH RECURSIVE ')}"
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body.removeprefix('WITH ')}"
    return f"WITH {ctes}\n{body}"
