"""Items and payments met with their orders once: several tables of a load ask for the lines, or for what they add up to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions import rules
from tillwork.functions.dates import date_key
from tillwork.operators.merge import one_per_key
from tillwork.operators.windows import first_orders
from tillwork.plans import dims, facts

DAY = "order_date"


def is_unique(orders: DataFrame) -> bool:
    """No id is on two orders.  Runs a job over the bare ids."""
    times = orders.where("order_id is not null").groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return times.where("n > 1").isEmpty()


def sold_lines(items: DataFrame, orders: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """A row for each item and each of ``orders`` with its id; keys are NULL where the customer, product or seller is unknown.

    ``orders`` have their ``customer_key``.  The sales, the sums per seller and those per order come from these rows, so
    items meet their orders once.  Orders of one time go by their id as a string.
    """
    first = first_orders(orders, "customer_id", facts.BOUGHT, "order_id", True).withColumn("first", F.lit(True))
    known = orders.select("order_id", "customer_key", facts.BOUGHT).join(first, "order_id", "left").select(
        "order_id",
        "customer_key",
        F.col(facts.BOUGHT).cast("date").alias(DAY),
        F.coalesce("first", F.lit(False)).alias("is_first_purchase"),
    )
    lines = items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value").join(known, "order_id")
    for ids, name in ((products, "product"), (sellers, "seller")):
        lines = lines.join(facts.keys_of(ids, name), f"{name}_id", "left")
    return lines.drop("product_id")


def paid_lines(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """A row for each payment and each of ``orders``, which have their ``customer_key``, with its id."""
    known = orders.select("order_id", "customer_id", "customer_key", F.col(facts.BOUGHT).cast("date").alias(DAY))
    return payments.join(known, "order_id")


def build_fact_sales(lines: DataFrame) -> DataFrame:
    """As ``facts.build_fact_sales``, of ``sold_lines``."""
    known = lines.where("customer_key is not null and product_key is not null and seller_key is not null")
    return known.select(
        "customer_key",
        "product_key",
        "seller_key",
        date_key(F.col(DAY)).alias("order_date_key"),
        "order_id",
        "order_item_id",
        "price",
        "freight_value",
        rules.line_total(F.col("price"), F.col("freight_value")).alias("total_value"),
        "is_first_purchase",
        (~F.col("is_first_purchase")).alias("is_repeat_customer"),
    )


def build_fact_payments(paid: DataFrame) -> DataFrame:
    """As ``facts.build_fact_payments``, of ``paid_lines``."""
    flags = rules.payment_flags(F.col("payment_installments"), F.col("payment_type"))
    return paid.where("customer_key is not null").select(
        "customer_key",
        date_key(F.col(DAY)).alias("payment_date_key"),
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
        *[c.alias(n) for n, c in flags.items()],
    )


def paid_by_customer(paid: DataFrame) -> DataFrame:
    """As ``dims.customer_stats``, of ``paid_lines``."""
    return dims.customer_sums(paid.select("customer_id", F.col(DAY).alias(facts.BOUGHT), F.lit(1).alias("n"), F.col("payment_value").alias("v")))


def sold_by_seller(lines: DataFrame) -> DataFrame:
    """As ``dims.seller_stats``, of the ``sold_lines`` with a seller."""
    value = (F.col("price") + F.col("freight_value")).alias("v")
    return dims.seller_sums(lines.where("seller_id is not null").select("seller_id", F.col(DAY).alias(facts.BOUGHT), F.lit(1).alias("n"), value))


def line_book(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """``orders``, each with an id of its own, with the sums and sellers of their ``sold_lines``; a very hot order is summed in parts."""
    freight = F.col("freight_value")
    sold = lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum(F.col("price") + freight).cast("decimal(20,2)").alias("total_value"),
        F.sum(freight).cast("decimal(20,2)").alias("total_freight"),
        F.collect_set("seller_id").alias("sellers"),
    )
    return orders.join(sold, "order_id", "left")


def order_book(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """``orders`` with the sums of their items, in all and per seller, and of their payments; NULL where there are none.

    Items move once, by order, as few narrow columns, and both sums are made where they are then: an order's items
    pass through one task as a stream, and the list ``sellers`` is no longer than there are sellers.
    """
    value, freight = F.col("price") + F.col("freight_value"), F.col("freight_value")
    placed = items.where("order_id is not null").select("order_id", "seller_id", "price", "freight_value").repartition("order_id")
    by_seller = placed.groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("v"), F.sum(freight).alias("f")
    )
    sold = by_seller.groupBy("order_id").agg(
        F.sum("n").alias("item_count"),
        F.sum("v").cast("decimal(20,2)").alias("total_value"),
        F.sum("f").cast("decimal(20,2)").alias("total_freight"),
        F.collect_list(F.when(F.col("seller_id").isNotNull(), F.struct("seller_id", "n", "v"))).alias("sellers"),
    )
    paid = payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("paid_n"), F.sum("payment_value").alias("paid_v"))
    return orders.join(sold, "order_id", "left").join(paid, "order_id", "left")


def customer_stats(book: DataFrame) -> DataFrame:
    """As ``dims.customer_stats``."""
    paid = book.where("paid_n is not null")
    return dims.customer_sums(paid.select("customer_id", facts.BOUGHT, F.col("paid_n").alias("n"), F.col("paid_v").alias("v")))


def seller_stats(book: DataFrame) -> DataFrame:
    """As ``dims.seller_stats``, of items with a seller."""
    return dims.seller_sums(book.select(facts.BOUGHT, F.inline("sellers")))


def build_fact_orders(
    book: DataFrame, dim_customer: DataFrame | None, statuses: DataFrame | None, unique: bool = False
) -> DataFrame:
    """As ``facts.build_fact_orders``; with ``statuses`` also the measures of ``facts.order_declared_measures``.

    Orders without an id have no declared measures.  Without ``dim_customer`` the book has the ``customer_key``;
    ``unique``: no id is in it twice, so rows need not meet.
    """
    zero = F.lit(0)
    columns = [
        "customer_key",
        date_key(F.col(facts.BOUGHT)).alias("purchase_date_key"),
        "order_id",
        F.coalesce("total_value", zero).cast("decimal(20,2)").alias("total_order_value"),
        F.coalesce("total_freight", zero).cast("decimal(20,2)").alias("total_freight_value"),
        F.coalesce("item_count", zero).alias("item_count"),
    ]
    if dim_customer is None:
        rows = book.where("customer_key is not null")
    else:
        rows = book.join(facts.keys_of(dim_customer, "customer"), "customer_id")
    if statuses is not None:
        rows = rows.join(
            statuses.select(F.col("status_value").alias("order_status"), "status_key"), "order_status", "left"
        )
        declared = {
            "unique_sellers": F.coalesce(F.when(F.col("sellers").isNotNull(), F.size("sellers")), zero).cast("bigint"),
            "status_key": F.col("status_key"),
            "approved_date_key": date_key(F.col("order_approved_at")),
            "delivered_date_key": date_key(F.col("order_delivered_customer_date")),
            "estimated_delivery_date_key": date_key(F.col("order_estimated_delivery_date")),
        }
        columns += [F.when(F.col("order_id").isNotNull(), c).alias(n) for n, c in declared.items()]
    rows = rows.select(*columns)
    return rows if unique else one_per_key(rows, ["order_id"])
