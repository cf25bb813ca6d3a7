"""Scans, sinks, writes, projections and filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillwork import catalog
from tillwork.functions import dates, rules
from tillwork.operators import merge
from tillwork.operators import relational as rel
from tillwork.operators.bayes import chain_as_store, get_stored_prior, monthly_chain
from tillwork.plans.dims import ORDER_STATUSES
from tillwork.session import work_path
from tillwork.sources import files
from tillwork.suite.parts import date_key, oracle
from tillwork.suite.registry import query

TEST_ID = "coupon_promo_v1"
CUTOFF = dt.date(1997, 10, 17)
FLOOR = dt.date(1996, 1, 1)
AS_OF = dt.date(2001, 9, 1)

ITEMS_SQL = oracle("""
    SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
           CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value FROM r_items""")


# -- scans, sinks, writes -----------------------------------------------------


@query("scan_csv", ITEMS_SQL)
def scan_csv(r):
    path = files.sink_csv(r.items, work_path(r.spark, "items-csv"))
    return files.scan_csv(r.spark, path, r.items.schema)


@query(
    "sink_csv",
    oracle("""
    SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
           review_creation_date FROM r_reviews"""),
)
def sink_csv(r):
    """Free text with quotes and line breaks has to survive the round trip."""
    path = files.sink_csv(r.reviews, work_path(r.spark, "reviews-csv"))
    return files.scan_csv(r.spark, path, r.reviews.schema)


@query(
    "sink_overwrite_table",
    oracle("SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM r_orders"),
)
def sink_overwrite_table(r):
    path = work_path(r.spark, "orders-table")
    files.sink_overwrite(r.orders.withColumn("order_status", F.lit("old")), path)
    files.sink_overwrite(r.orders, path)
    return files.scan_table(r.spark, path)


@query(
    "scan_sql_params",
    oracle("""
    SELECT order_status, count(*) AS n FROM r_orders
    WHERE order_purchase_timestamp >= TIMESTAMP '1997-03-01'
      AND order_purchase_timestamp < TIMESTAMP '1997-04-01' GROUP BY order_status"""),
)
def scan_sql_params(r):
    return files.scan_sql(
        r.spark,
        "SELECT order_status, count(*) AS n FROM {orders} "
        "WHERE order_purchase_timestamp >= :first AND order_purchase_timestamp < :after "
        "GROUP BY order_status",
        {"first": dt.date(1997, 3, 1), "after": dt.date(1997, 4, 1)},
        orders=r.orders,
    )


@query(
    "ctas_temp",
    oracle("SELECT customer_state, count(*) AS customers FROM r_customers GROUP BY customer_state"),
)
def ctas_temp(r):
    staged = merge.ctas_temp(r.customers, "staged_customers")
    return staged.groupBy("customer_state").agg(F.count(F.lit(1)).alias("customers"))


@query(
    "insert_select",
    oracle("""
    SELECT order_id, customer_id, order_status, 'web' AS channel FROM r_orders WHERE order_status = 'created'
    UNION ALL
    SELECT order_id, customer_id, NULL, 'unknown' FROM r_orders WHERE order_status <> 'created'"""),
)
def insert_select(r):
    target = r.orders.where(F.col("order_status") == "created").select(
        "order_id", "customer_id", "order_status", F.lit("web").alias("channel")
    )
    source = r.orders.where(F.col("order_status") != "created")
    return merge.insert_select(target, source, ["order_id", "customer_id"], {"channel": "unknown"})


STATUS_VALUES = ", ".join(f"('{v}', '{d}', {str(f).upper()}, {o})" for v, d, f, o in ORDER_STATUSES)


@query(
    "values_table",
    oracle(f"""
    SELECT s.status_value, s.status_description, s.is_final_status, CAST(s.status_order AS INTEGER) AS status_order,
           count(o.order_id) AS orders
    FROM (VALUES {STATUS_VALUES}) AS s(status_value, status_description, is_final_status, status_order)
    LEFT JOIN r_orders o ON o.order_status = s.status_value GROUP BY ALL"""),
)
def values_table(r):
    """Literal rows, joined with the number of orders in each status."""
    literal = files.values_table(
        r.spark,
        ORDER_STATUSES,
        "status_value string, status_description string, is_final_status boolean, status_order int",
    )
    counts = r.orders.groupBy(F.col("order_status").alias("status_value")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return literal.join(counts, "status_value", "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0)).cast("bigint")
    )


def _accounts(r):
    return r.table("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
    )


RUN_TS = dt.datetime(2020, 1, 1)


@query(
    "merge_upsert",
    """
    WITH old AS (SELECT c_custkey, c_mktsegment, CAST(c_acctbal AS DECIMAL(12,2)) AS bal FROM customer
                 WHERE c_mktsegment <> 'BUILDING'),
         new AS (SELECT c_custkey, 'NEW' AS seg, CAST(c_acctbal AS DECIMAL(12,2)) + 10 AS bal FROM customer
                 WHERE c_acctbal > 0)
    SELECT coalesce(o.c_custkey, n.c_custkey) AS customer_id,
           CASE WHEN o.c_custkey IS NULL THEN n.seg ELSE o.c_mktsegment END AS segment,
           CAST(CASE WHEN n.c_custkey IS NULL THEN o.bal ELSE n.bal END AS DOUBLE) AS balance,
           CASE WHEN n.c_custkey IS NOT NULL THEN TIMESTAMP '2020-01-01' ELSE TIMESTAMP '2019-01-01' END AS updated_at
    FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey""",
)
def merge_upsert(r):
    """Balances refresh, segments stay; new customers come in whole."""
    stored = (
        _accounts(r)
        .where(F.col("segment") != "BUILDING")
        .withColumn("updated_at", F.lit(dt.datetime(2019, 1, 1)).cast("timestamp_ntz"))
    )
    batch = (
        _accounts(r)
        .where(F.col("balance") > 0)
        .select(
            "customer_id",
            F.lit("NEW").alias("segment"),
            (F.col("balance") + 10).cast("decimal(12,2)").alias("balance"),
        )
    )
    return merge.merge_upsert(
        stored, batch, ["customer_id"], ["balance"], touch_col="updated_at", run_ts=RUN_TS
    )


@query(
    "merge_insert_absent",
    """
    WITH old AS (SELECT DISTINCT l_orderkey, 'stored' AS origin FROM lineitem WHERE l_returnflag = 'N')
    SELECT l_orderkey AS order_id, origin FROM old
    UNION ALL
    SELECT l_orderkey, min(l_returnflag) FROM lineitem
    WHERE l_orderkey NOT IN (SELECT l_orderkey FROM old) GROUP BY l_orderkey""",
)
def merge_insert_absent(r):
    """The batch repeats its keys; each new key comes in once."""
    lines = r.table("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_returnflag").alias("origin"))
    stored = lines.where(F.col("origin") == "N").select("order_id").distinct().withColumn("origin", F.lit("stored"))
    return merge.merge_insert_absent(stored, lines, ["order_id"])


@query(
    "append_no_key",
    oracle("""
    SELECT order_id, order_status, CAST(2 AS BIGINT) AS copies FROM r_orders"""),
)
def append_no_key(r):
    """The same batch twice is every row twice."""
    batch = r.orders.select("order_id", "order_status")
    return (
        merge.append_rows(batch, batch)
        .groupBy("order_id", "order_status")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


@query(
    "append_dedupe_keys",
    oracle("SELECT order_id, order_status FROM r_orders"),
)
def append_dedupe_keys(r):
    batch = r.orders.select("order_id", "order_status")
    return merge.append_rows(batch, batch, dedupe_keys=["order_id"])


@query(
    "column_defaults",
    oracle("""
    SELECT product_id, CAST(coalesce(product_weight_g, 0) AS DOUBLE) AS product_weight_g, FALSE AS discontinued,
           TIMESTAMP '2020-01-01' AS created_at FROM r_products"""),
)
def column_defaults(r):
    return merge.with_defaults(
        r.products.select("product_id", "product_weight_g"),
        {"product_weight_g": 0, "discontinued": False, "created_at": RUN_TS},
    ).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("surrogate_key", oracle("SELECT customer_key, customer_id FROM k_customer"))
def surrogate_key(r):
    return merge.surrogate_key(r.customers.select("customer_id"), "customer_id", "customer_key")


@query(
    "surrogate_key_extend",
    oracle("""
    SELECT c_custkey AS customer_id,
           CASE WHEN stored THEN c_custkey + 1 ELSE (SELECT max(c_custkey) + 1 FROM customer WHERE c_mktsegment <> 'BUILDING')
             + row_number() OVER (PARTITION BY stored ORDER BY
                 CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 4096, c_custkey) END
             AS customer_key
    FROM (SELECT c_custkey, c_mktsegment <> 'BUILDING' AS stored FROM customer)"""),
)
def surrogate_key_extend(r):
    """Rows that already have a key keep it; the others continue after the largest."""
    stored = F.when(F.col("segment") != "BUILDING", F.col("customer_id") + 1)
    rows = _accounts(r).select("customer_id", stored.alias("customer_key"))
    return merge.surrogate_key(rows, "customer_id", "customer_key")


@query("row_key", "SELECT i AS sale_key FROM range(1, (SELECT count(*) + 1 FROM lineitem)) AS t(i)")
def row_key(r):
    """Which row has which number is free, so only the numbers are compared."""
    return merge.row_key(r.items, "sale_key").select("sale_key")


@query("drop_columns", oracle("SELECT order_id, order_status FROM r_orders"))
def drop_columns(r):
    indexed = r.orders.select(F.monotonically_increasing_id().alias("Unnamed: 0"), "order_id", "order_status")
    return rel.drop_columns(indexed, "Unnamed: 0")


@query(
    "preview_head",
    oracle("SELECT customer_id, customer_city, customer_state FROM r_customers ORDER BY customer_id LIMIT 5"),
)
def preview_head(r):
    return files.preview(r.customers.select("customer_id", "customer_city", "customer_state"), ["customer_id"])


@query(
    "schema_create",
    oracle("""
    SELECT NULL::BIGINT AS status_key, CAST(order_id AS VARCHAR) AS order_id, NULL::BIGINT AS item_count FROM r_orders"""),
)
def schema_create(r):
    """A table made from the catalog takes the orders; what they lack is NULL."""
    empty = files.empty_table(r.spark, catalog.ANALYTICS["fact_orders"])
    return merge.insert_select(empty, r.orders, ["order_id"]).select("status_key", "order_id", "item_count")


# -- projections --------------------------------------------------------------


@query(
    "project_alias",
    oracle("SELECT order_id AS id, CAST(price * 2 AS DOUBLE) AS double_price FROM r_items"),
)
def project_alias(r):
    return rel.project(r.items, {"id": F.col("order_id"), "double_price": F.col("price") * 2})


@query(
    "rename_columns",
    oracle("SELECT product_id, product_name_length, product_description_length FROM r_products"),
)
def rename_columns(r):
    # fixed values: the two misspelt names and their correction
    names = {
        "product_name_lenght": "product_name_length",
        "product_description_lenght": "product_description_length",
    }
    misspelt = r.products.select("product_id", *[F.col(v).alias(k) for k, v in names.items()])
    return rel.rename(misspelt, names)


@query(
    "cast_numeric",
    oracle("SELECT order_id, CAST(price AS DOUBLE) AS price, CAST(order_item_id AS INTEGER) AS order_item_id FROM r_items"),
)
def cast_numeric(r):
    text = r.items.select(
        "order_id", F.col("price").cast("string").alias("price"),
        F.col("order_item_id").cast("string").alias("order_item_id"),
    )
    return rel.cast_strict(text, {"price": "double", "order_item_id": "int"})


@query("parse_timestamps", oracle("SELECT order_id, order_purchase_timestamp FROM r_orders"))
def parse_timestamps(r):
    text = r.orders.select(
        "order_id",
        F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss").alias("order_purchase_timestamp"),
    )
    return rel.parse_timestamps(text, ["order_purchase_timestamp"])


@query(
    "coerce_numeric",
    "SELECT p_partkey AS product_id, TRY_CAST(p_size || CASE WHEN p_size > 40 THEN 'cm' ELSE '' END AS DOUBLE) AS size "
    "FROM part",
)
def coerce_numeric(r):
    unit = F.when(F.col("p_size") > 40, "cm").otherwise("")
    text = r.table("part").select(
        F.col("p_partkey").alias("product_id"), F.concat(F.col("p_size").cast("string"), unit).alias("size")
    )
    return rel.coerce_numeric(text, ["size"])


@query("customer_segment", oracle("SELECT customer_id, customer_segment FROM d_customer"))
def customer_segment(r):
    from tillwork.plans.dims import customer_stats

    stats = customer_stats(r.orders, r.payments)
    segment = rules.customer_segment(F.col("order_count"), F.col("total_spent"))
    return r.customers.join(stats, "customer_id", "left").select("customer_id", segment.alias("customer_segment"))


@query(
    "customer_segment_year",
    """
    SELECT c_custkey AS customer_id,
           CASE WHEN n = 1 THEN 'new' WHEN n BETWEEN 2 AND 5 THEN 'returning'
                WHEN spent > 1000000 THEN 'vip' ELSE 'regular' END AS customer_segment
    FROM customer LEFT JOIN (
        SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS spent FROM orders
        WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1)
      ON c_custkey = o_custkey""",
)
def customer_segment_year(r):
    """One year of orders, where all four branches of the rule occur."""
    year = rel.where_between(
        r.table("orders"), "o_orderdate", F.lit("1997-01-01"), F.lit("1997-12-31 23:59:59.999999")
    )
    stats = year.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("spent")
    )
    segment = rules.customer_segment(F.col("n"), F.col("spent"), vip_above=1_000_000)
    return (
        r.table("customer")
        .join(stats, "c_custkey", "left")
        .select(F.col("c_custkey").alias("customer_id"), segment.alias("customer_segment"))
    )


@query(
    "seller_segment",
    oracle("""
    SELECT seller_id, 'all' AS span, seller_segment FROM d_seller
    UNION ALL
    SELECT s_suppkey, '1997-03', CASE WHEN n < 10 THEN 'small' WHEN n <= 100 THEN 'medium' ELSE 'large' END
    FROM supplier LEFT JOIN (
        SELECT l_suppkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01' GROUP BY 1)
      ON s_suppkey = l_suppkey"""),
)
def seller_segment(r):
    """Over everything and over one month, so that every branch occurs."""
    from tillwork.plans.dims import seller_stats

    month = r.orders.where(
        (F.col("order_purchase_timestamp") >= F.lit("1997-03-01").cast("timestamp_ntz"))
        & (F.col("order_purchase_timestamp") < F.lit("1997-04-01").cast("timestamp_ntz"))
    )
    parts = [
        r.sellers.join(seller_stats(r.items, orders), "seller_id", "left").select(
            "seller_id",
            F.lit(span).alias("span"),
            rules.seller_segment(F.col("sales_count")).alias("seller_segment"),
        )
        for span, orders in (("all", r.orders), ("1997-03", month))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "product_flags",
    oracle("""
    SELECT product_id, product_weight_g > 1000 AS is_heavy_item,
           product_length_cm * product_height_cm * product_width_cm > 10000 AS is_large_item FROM r_products"""),
)
def product_flags(r):
    size = [F.col(f"product_{side}_cm") for side in ("length", "height", "width")]
    return rel.project(
        r.products,
        {"product_id": F.col("product_id"), **rules.product_flags(F.col("product_weight_g"), *size)},
    )


@query(
    "payment_flags",
    oracle("""
    SELECT order_id, payment_sequential, payment_installments > 1 AS is_installment_payment,
           payment_type = 'credit_card' AS is_credit_card FROM r_payments"""),
)
def payment_flags(r):
    flags = rules.payment_flags(F.col("payment_installments"), F.col("payment_type"))
    return rel.project(
        r.payments,
        {"order_id": F.col("order_id"), "payment_sequential": F.col("payment_sequential"), **flags},
    )


@query(
    "review_flags",
    oracle("""
    SELECT review_id, msg IS NOT NULL AND length(msg) > 0 AS has_comment,
           CAST(coalesce(length(msg), 0) AS INTEGER) AS comment_length
    FROM (SELECT review_id, CASE WHEN review_score = 1 THEN NULL WHEN review_score = 0 THEN ''
                                 ELSE review_comment_message END AS msg FROM r_reviews)"""),
)
def review_flags(r):
    """Messages blanked by score, so that NULL, empty and full ones occur."""
    score = F.col("review_score")
    message = F.when(score == 1, None).when(score == 0, "").otherwise(F.col("review_comment_message"))
    return r.reviews.select("review_id", message.alias("m")).select(
        "review_id", *[c.alias(n) for n, c in rules.review_flags(F.col("m")).items()]
    )


@query(
    "line_total_value",
    oracle("SELECT order_id, order_item_id, CAST(price + freight_value AS DOUBLE) AS total_value FROM r_items"),
)
def line_total_value(r):
    total = rules.line_total(F.col("price"), F.col("freight_value"))
    return r.items.select("order_id", "order_item_id", total.alias("total_value"))


@query(
    "literal_columns",
    oracle("SELECT order_id, 'exposure' AS event_type, CAST(1 AS INTEGER) AS weight, FALSE AS is_test FROM r_orders"),
)
def literal_columns(r):
    return rel.with_literals(
        r.orders.select("order_id"), {"event_type": "exposure", "weight": 1, "is_test": False}
    )


# -- filters ------------------------------------------------------------------


@query(
    "filter_null_or",
    oracle("""
    SELECT product_id, CAST(product_weight_g AS DOUBLE) AS product_weight_g FROM r_products
    WHERE product_weight_g IS NULL OR product_length_cm IS NULL"""),
)
def filter_null_or(r):
    rows = rel.where_any_null(r.products, ["product_weight_g", "product_length_cm"])
    return rows.select("product_id", "product_weight_g")


@query(
    "filter_date_logic",
    oracle(f"""
    SELECT order_id, order_purchase_timestamp, order_delivered_customer_date FROM r_delivery
    WHERE order_delivered_customer_date < order_purchase_timestamp
       OR order_purchase_timestamp < DATE '{FLOOR}' OR order_delivered_customer_date > DATE '{AS_OF}'"""),
)
def filter_date_logic(r):
    bought, arrived = "order_purchase_timestamp", "order_delivered_customer_date"
    rows = rel.where_bad_dates(r.orders_with_delivery, bought, arrived, FLOOR, AS_OF)
    return rows.select("order_id", bought, arrived)


def _keyed_orders(r):
    return r.orders.select("order_id", dates.date_key(F.col("order_purchase_timestamp")).alias("order_date_key"))


KEYED = f"(SELECT order_id, {date_key('order_purchase_timestamp')} AS order_date_key FROM r_orders)"


@query(
    "filter_month_key_range",
    oracle(f"SELECT * FROM {KEYED} WHERE order_date_key >= 19970301 AND order_date_key < 19970331"),
)
def filter_month_key_range(r):
    return rel.where_month_key(_keyed_orders(r), "order_date_key", 1997, 3)


@query(
    "filter_month_half_open",
    oracle(f"SELECT * FROM {KEYED} WHERE order_date_key // 100 = 199712"),
)
def filter_month_half_open(r):
    return rel.where_month_key_half_open(_keyed_orders(r), "order_date_key", 1997, 12)


def stored_chain(r):
    """The prior store that the sample events lead to, by day."""
    return chain_as_store(monthly_chain(r.trial_counts(TEST_ID)))


@query(
    "point_lookup_prior",
    oracle("""
    SELECT CAST(alpha_value AS DOUBLE) AS alpha_value, CAST(beta_value AS DOUBLE) AS beta_value, data_points,
           conversions, 'updated' AS calculation_method, 'Chained update' AS notes
    FROM store WHERE test_id = 'coupon_promo_v1' AND variant_id = 'A' AND period_date = DATE '2024-01-15'
      AND value_type = 'prior'"""),
)
def point_lookup_prior(r):
    return get_stored_prior(stored_chain(r), TEST_ID, "A", dt.date(2024, 1, 15))


@query(
    "optional_filter",
    oracle("SELECT order_id, order_status FROM r_orders WHERE order_status = 'created'"),
)
def optional_filter(r):
    rows = r.orders.select("order_id", "order_status")
    return rel.where_optional(rows, {"order_status": "created", "order_id": None})


@query("filter_cutoff_date", oracle(f"SELECT * FROM {KEYED} WHERE order_date_key <= 19971017"))
def filter_cutoff_date(r):
    return rel.where_until(_keyed_orders(r), "order_date_key", CUTOFF)


@query(
    "filter_in_between",
    oracle("""
    SELECT order_id, order_purchase_timestamp FROM r_orders
    WHERE dayofweek(order_purchase_timestamp) IN (0, 6) AND quarter(order_purchase_timestamp) BETWEEN 2 AND 3"""),
)
def filter_in_between(r):
    d = F.col("order_purchase_timestamp")
    parts = r.orders.select("order_id", d, dates.day_of_week(d).alias("dow"), F.quarter(d).alias("q"))
    rows = rel.where_between(rel.where_in(parts, "dow", [0, 6]), "q", 2, 3)
    return rows.select("order_id", "order_purchase_timestamp")


@query("filter_missing_rows", oracle("SELECT review_id FROM r_reviews WHERE review_score IS NULL"))
def filter_missing_rows(r):
    return rel.where_missing(r.reviews, "review_score").select("review_id")
