"""Data-quality checks over the sample tables."""

from __future__ import annotations


from pyspark.sql import functions as F

from tillwork.operators import quality as q
from tillwork.plans.dims import build_dim_product
from tillwork.suite.basics import AS_OF, FLOOR
from tillwork.suite.joins_aggs import sales
from tillwork.suite.parts import oracle
from tillwork.suite.registry import query

BOUGHT, ARRIVED = "order_purchase_timestamp", "order_delivered_customer_date"


def check(name: str, severity: str, violations: str) -> str:
    """One row of the report; ``violations`` is a scalar expression or subquery."""
    return (
        f"SELECT '{name}' AS check_name, '{severity}' AS severity, CAST(v AS BIGINT) AS violations, v = 0 AS passed "
        f"FROM (SELECT ({violations}) AS v)"
    )


def checks(*rows: tuple[str, str, str]) -> str:
    return oracle("\nUNION ALL\n".join(check(*row) for row in rows))


@query(
    "dq_null_critical",
    checks(
        ("nulls:customers", "warn",
         "SELECT count(*) FROM r_customers WHERE customer_id IS NULL OR customer_unique_id IS NULL"),
        ("nulls:reviews", "warn", "SELECT count(*) FROM r_reviews WHERE review_id IS NULL OR review_score IS NULL"),
    ),
)
def dq_null_critical(r):
    customers = q.check_nulls(r.customers, ["customer_id", "customer_unique_id"], "nulls:customers")
    reviews = q.check_nulls(r.reviews, ["review_id", "review_score"], "nulls:reviews")
    return customers.unionByName(reviews)


ORPHANS = "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer"


@query(
    "dq_referential_integrity",
    checks(
        ("fk:all", "fail", ORPHANS + ")"),
        ("fk:without_building", "fail", ORPHANS + " WHERE c_mktsegment <> 'BUILDING')"),
    ),
)
def dq_referential_integrity(r):
    """Against all customers, and against customers without one segment."""
    parents = r.table("customer")
    fewer = parents.where(F.col("c_mktsegment") != "BUILDING")
    return q.check_fk(r.orders, "customer_id", parents, "c_custkey", "fk:all").unionByName(
        q.check_fk(r.orders, "customer_id", fewer, "c_custkey", "fk:without_building")
    )


BAD_DATES = f"""SELECT count(*) FROM r_delivery WHERE {ARRIVED} < {BOUGHT}
    OR {BOUGHT} < DATE '{FLOOR}' OR {ARRIVED} > DATE '{AS_OF}'"""


@query("dq_date_ranges", checks(("date_ranges", "warn", BAD_DATES)))
def dq_date_ranges(r):
    return q.check_dates(r.orders_with_delivery, BOUGHT, ARRIVED, FLOOR, AS_OF)


def _events(r):
    """The sample events, with the user in the place of the customer key."""
    return r.table("events").select(F.col("user_id").alias("customer_key"), "event_type")


@query(
    "dq_events_nonempty",
    """
    SELECT 'events' AS check_name, 'fail' AS severity, CAST(0 AS BIGINT) AS violations, TRUE AS passed,
           count(*) AS total_events, count(DISTINCT user_id) AS unique_customers FROM events
    UNION ALL
    SELECT 'no_events', 'fail', CAST(1 AS BIGINT), FALSE, count(*), count(DISTINCT user_id)
    FROM events WHERE event_type = 'exposure'""",
)
def dq_events_nonempty(r):
    """On all events, and on a kind of event that does not occur."""
    none = _events(r).where(F.col("event_type") == "exposure")
    return q.check_events(_events(r), "events").unionByName(q.check_events(none, "no_events"))


@query(
    "dq_unique_key",
    checks(
        ("unique:orders", "fail",
         "SELECT count(*) FROM (SELECT 1 FROM r_orders GROUP BY order_id HAVING count(*) > 1)"),
        ("unique:payments", "fail",
         "SELECT count(*) FROM (SELECT 1 FROM r_payments GROUP BY order_id, payment_sequential HAVING count(*) > 1)"),
    ),
)
def dq_unique_key(r):
    return q.check_unique(r.orders, ["order_id"], "unique:orders").unionByName(
        q.check_unique(r.payments, ["order_id", "payment_sequential"], "unique:payments")
    )


@query(
    "dq_not_null",
    checks(
        *[
            (f"not_null:products.{c}", "fail", f"SELECT count(*) FROM r_products WHERE {c} IS NULL")
            for c in ("product_id", "product_category_name", "product_weight_g")
        ]
    ),
)
def dq_not_null(r):
    return q.check_not_null(r.products, ["product_id", "product_category_name", "product_weight_g"], "products")


def age(days: int) -> str:
    return (
        f"SELECT CASE WHEN datediff('day', CAST(max({BOUGHT}) AS DATE), DATE '{AS_OF}') <= {days} THEN 0 ELSE 1 END "
        "FROM r_orders"
    )


@query("dq_freshness", checks(("fresh_60", "warn", age(60)), ("fresh_7", "warn", age(7))))
def dq_freshness(r):
    return q.check_freshness(r.orders, BOUGHT, AS_OF, 60, "fresh_60").unionByName(
        q.check_freshness(r.orders, BOUGHT, AS_OF, 7, "fresh_7")
    )


@query(
    "dq_report",
    checks(
        ("nulls:customers", "warn",
         "SELECT count(*) FROM r_customers WHERE customer_id IS NULL OR customer_unique_id IS NULL"),
        ("not_null:customers.customer_id", "fail", "SELECT count(*) FROM r_customers WHERE customer_id IS NULL"),
        ("dates:orders", "warn", BAD_DATES),
        ("freshness:orders", "warn", age(31)),
        ("not_null:orders.order_id", "fail", "SELECT count(*) FROM r_orders WHERE order_id IS NULL"),
        ("unique:customers", "fail",
         "SELECT count(*) FROM (SELECT 1 FROM r_customers GROUP BY customer_id HAVING count(*) > 1)"),
        ("unique:orders", "fail",
         "SELECT count(*) FROM (SELECT 1 FROM r_orders GROUP BY order_id HAVING count(*) > 1)"),
        ("fk:orders.customer_id", "fail", ORPHANS + ")"),
        ("nonempty:events", "fail", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM events"),
    ),
)
def dq_report(r):
    tables = {"customers": r.customers, "orders": r.orders_with_delivery, "events": _events(r)}
    return q.quality_report(tables, AS_OF, FLOOR)


@query(
    "dq_star_report",
    checks(
        *[(f"not_null:dim_product.{c}", "fail", "SELECT 0") for c in ("product_key", "product_id")],
        *[(f"unique:dim_product({c})", "fail", "SELECT 0") for c in ("product_key", "product_id")],
        ("fk:fact_sales.product_key", "fail",
         "SELECT count(*) FROM f_sales WHERE product_key NOT IN (SELECT product_key FROM k_product)"),
    ),
)
def dq_star_report(r):
    """Declared constraints of a dimension and of the sales that refer to it."""
    return q.star_report({"dim_product": build_dim_product(r.products), "fact_sales": sales(r)})
