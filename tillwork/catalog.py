"""Table definitions: columns, keys, required columns and references.

Identifiers are strings in this catalog.  Builders keep whatever identifier
type their inputs have (bigint joins are cheaper); ``conform`` casts to the
catalog on the way into a stored table.  Sums over many rows are wider than
one row's money columns so that a very large customer cannot overflow them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "str": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "ts": T.TimestampNTZType(),
    "cm": T.DecimalType(12, 2),
    "item": T.DecimalType(12, 2),
    "money": T.DecimalType(20, 2),
    "ratio": T.DecimalType(5, 2),
    "rating": T.DecimalType(3, 2),
    "param": T.DecimalType(15, 6),
}


def _table(spec: str) -> T.StructType:
    fields = []
    for part in spec.replace("\n", " ").split(","):
        name, kind = part.split()
        required = kind.endswith("!")
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not required))
    return T.StructType(fields)


OPERATIONAL: dict[str, T.StructType] = {
    "customers": _table("""customer_id str, customer_unique_id str, customer_zip_code_prefix str,
        customer_city str, customer_state str"""),
    "orders": _table("""order_id str, customer_id str, order_status str, order_purchase_timestamp ts,
        order_approved_at ts, order_delivered_carrier_date ts, order_delivered_customer_date ts,
        order_estimated_delivery_date ts"""),
    "order_items": _table("""order_id str, order_item_id int, product_id str, seller_id str,
        shipping_limit_date ts, price item, freight_value item"""),
    "order_payments": _table("""order_id str, payment_sequential int, payment_type str,
        payment_installments int, payment_value item"""),
    "order_reviews": _table("""review_id str, order_id str, review_score int, review_comment_title str,
        review_comment_message str, review_creation_date ts"""),
    "products": _table("""product_id str, product_category_name str, product_name_length int,
        product_description_length int, product_photos_qty int, product_weight_g cm,
        product_length_cm cm, product_height_cm cm, product_width_cm cm"""),
    "sellers": _table("""seller_id str, seller_zip_code_prefix str, seller_city str, seller_state str"""),
}

ANALYTICS: dict[str, T.StructType] = {
    "dim_customer": _table("""customer_key long!, customer_id str!, customer_unique_id str,
        customer_zip_code_prefix str, customer_city str, customer_state str, customer_segment str,
        first_order_date date, last_order_date date, total_orders long, lifetime_value money,
        created_at ts, updated_at ts"""),
    "dim_product": _table("""product_key long!, product_id str!, product_category_name str,
        product_name_length int, product_description_length int, product_photos_qty int,
        product_weight_g cm, product_length_cm cm, product_height_cm cm, product_width_cm cm,
        is_heavy_item bool, is_large_item bool, created_at ts, updated_at ts"""),
    "dim_seller": _table("""seller_key long!, seller_id str!, seller_zip_code_prefix str,
        seller_city str, seller_state str, seller_segment str, first_sale_date date,
        last_sale_date date, total_sales long, total_revenue money, avg_rating rating,
        created_at ts, updated_at ts"""),
    "dim_date": _table("""date_key int!, full_date date!, year int, quarter int, month int,
        month_name str, week int, week_of_year int, day_of_month int, day_of_year int,
        day_of_week int, day_name str, is_weekend bool, created_at ts"""),
    "dim_ab_test": _table("""test_key long!, test_id str!, test_name str, test_type str,
        hypothesis str, start_date date, end_date date, status str, success_metric str,
        created_at ts"""),
    "dim_test_variant": _table("""variant_key long!, test_key long, variant_id str,
        variant_name str, description str, is_control bool, traffic_allocation ratio,
        created_at ts"""),
    "dim_order_status": _table("""status_key long!, status_value str!, status_description str,
        is_final_status bool, status_order int"""),
    "fact_sales": _table("""sale_key long, customer_key long, product_key long, seller_key long,
        order_date_key int, shipped_date_key int, delivered_date_key int, test_key long,
        variant_key long, order_id str, order_item_id int, price item, freight_value item,
        total_value item, is_first_purchase bool, is_repeat_customer bool, created_at ts"""),
    "fact_orders": _table("""order_key long, customer_key long, purchase_date_key int,
        approved_date_key int, delivered_date_key int, estimated_delivery_date_key int,
        test_key long, variant_key long, status_key long, order_id str, total_order_value money,
        total_freight_value money, item_count long, unique_sellers long, created_at ts"""),
    "fact_payments": _table("""payment_key long, customer_key long, payment_date_key int,
        test_key long, variant_key long, order_id str, payment_sequential int, payment_type str,
        payment_installments int, payment_value item, is_installment_payment bool,
        is_credit_card bool, created_at ts"""),
    "fact_reviews": _table("""review_key long, customer_key long, product_key long, seller_key long,
        review_date_key int, answer_date_key int, review_id str, order_id str, review_score int,
        review_comment_title str, review_comment_message str, has_comment bool,
        comment_length int, sentiment_score rating, created_at ts"""),
    "fact_ab_test_events": _table("""event_key long, customer_key long, test_key long,
        variant_key long, event_date_key int, order_id str, event_type str, event_timestamp ts,
        session_id str, conversion_value item, is_conversion bool, created_at ts"""),
    "bayesian_priors_store": _table("""prior_id long, test_id str!, variant_id str!,
        period_date date!, alpha_value param!, beta_value param!, value_type str!,
        data_points long, conversions long, calculation_method str, notes str, created_at ts"""),
}

# Declared keys: every list is unique in its table.
UNIQUE_KEYS: dict[str, list[list[str]]] = {
    "dim_customer": [["customer_key"], ["customer_id"]],
    "dim_product": [["product_key"], ["product_id"]],
    "dim_seller": [["seller_key"], ["seller_id"]],
    "dim_date": [["date_key"], ["full_date"]],
    "dim_ab_test": [["test_key"], ["test_id"]],
    "dim_test_variant": [["variant_key"], ["test_key", "variant_id"]],
    "dim_order_status": [["status_key"], ["status_value"]],
    "fact_orders": [["order_id"]],
    "bayesian_priors_store": [["test_id", "variant_id", "period_date", "value_type"]],
}

# child table, child column, parent table, parent column
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("dim_test_variant", "test_key", "dim_ab_test", "test_key"),
    ("fact_sales", "customer_key", "dim_customer", "customer_key"),
    ("fact_sales", "product_key", "dim_product", "product_key"),
    ("fact_sales", "seller_key", "dim_seller", "seller_key"),
    ("fact_sales", "order_date_key", "dim_date", "date_key"),
    ("fact_sales", "shipped_date_key", "dim_date", "date_key"),
    ("fact_sales", "delivered_date_key", "dim_date", "date_key"),
    ("fact_sales", "test_key", "dim_ab_test", "test_key"),
    ("fact_sales", "variant_key", "dim_test_variant", "variant_key"),
    ("fact_orders", "customer_key", "dim_customer", "customer_key"),
    ("fact_orders", "purchase_date_key", "dim_date", "date_key"),
    ("fact_orders", "approved_date_key", "dim_date", "date_key"),
    ("fact_orders", "delivered_date_key", "dim_date", "date_key"),
    ("fact_orders", "estimated_delivery_date_key", "dim_date", "date_key"),
    ("fact_orders", "test_key", "dim_ab_test", "test_key"),
    ("fact_orders", "variant_key", "dim_test_variant", "variant_key"),
    ("fact_orders", "status_key", "dim_order_status", "status_key"),
    ("fact_payments", "customer_key", "dim_customer", "customer_key"),
    ("fact_payments", "payment_date_key", "dim_date", "date_key"),
    ("fact_payments", "test_key", "dim_ab_test", "test_key"),
    ("fact_payments", "variant_key", "dim_test_variant", "variant_key"),
    ("fact_reviews", "customer_key", "dim_customer", "customer_key"),
    ("fact_reviews", "product_key", "dim_product", "product_key"),
    ("fact_reviews", "seller_key", "dim_seller", "seller_key"),
    ("fact_reviews", "review_date_key", "dim_date", "date_key"),
    ("fact_reviews", "answer_date_key", "dim_date", "date_key"),
    ("fact_ab_test_events", "customer_key", "dim_customer", "customer_key"),
    ("fact_ab_test_events", "test_key", "dim_ab_test", "test_key"),
    ("fact_ab_test_events", "variant_key", "dim_test_variant", "variant_key"),
    ("fact_ab_test_events", "event_date_key", "dim_date", "date_key"),
]

# Column a fact table is laid out by (the month of this date key).
FACT_DATE_KEY: dict[str, str] = {
    "fact_sales": "order_date_key",
    "fact_orders": "purchase_date_key",
    "fact_payments": "payment_date_key",
    "fact_reviews": "review_date_key",
    "fact_ab_test_events": "event_date_key",
}


def required_columns(table: str) -> list[str]:
    return [f.name for f in ANALYTICS[table].fields if not f.nullable]


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``table`` in order and type; those ``df`` lacks are NULL."""
    have = set(df.columns)
    return df.select(
        [
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ANALYTICS[table].fields
        ]
    )
