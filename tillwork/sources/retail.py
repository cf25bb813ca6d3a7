"""Retail tables expressed over the sample star schema.

The sample data has no e-commerce tables, so each one is a projection of the
nearest sample table.  Money is cast to decimal at the scan, which keeps every
later sum exact.  All of these stay lazy and prune: a query that needs two
columns reads two columns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions.scalars import hash_bucket


class Retail:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def places(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey",
            F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("zip_code_prefix"),
            F.col("r_name").alias("city"),
            F.col("n_name").alias("state"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        c = self.table("customer")
        return c.join(self.places, c.c_nationkey == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            F.col("zip_code_prefix").alias("customer_zip_code_prefix"),
            F.col("city").alias("customer_city"),
            F.col("state").alias("customer_state"),
        )

    @cached_property
    def sellers(self) -> DataFrame:
        s = self.table("supplier")
        return s.join(self.places, s.s_nationkey == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("zip_code_prefix").alias("seller_zip_code_prefix"),
            F.col("city").alias("seller_city"),
            F.col("state").alias("seller_state"),
        )

    @cached_property
    def products(self) -> DataFrame:
        size = F.nullif(F.col("p_size"), F.lit(13))
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.length("p_name").alias("product_name_length"),
            F.length("p_brand").alias("product_description_length"),
            (F.col("p_size") % 5).alias("product_photos_qty"),
            (size * 40).cast("decimal(12,2)").alias("product_weight_g"),
            size.cast("decimal(12,2)").alias("product_length_cm"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("product_height_cm"),
            F.lit("0.40").cast("decimal(12,2)").alias("product_width_cm"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        """Purchase facts only; see ``orders_with_delivery`` for the later dates."""
        status = (
            F.when(F.col("o_orderstatus") == "F", "delivered")
            .when(F.col("o_orderstatus") == "P", "processing")
            .otherwise("created")
        )
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            status.alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
        )

    @cached_property
    def orders_with_delivery(self) -> DataFrame:
        shipped = self.items.groupBy("order_id").agg(
            F.min("shipping_limit_date").alias("order_delivered_carrier_date"),
            F.max("shipping_limit_date").alias("order_delivered_customer_date"),
        )
        bought = F.col("order_purchase_timestamp")
        return self.orders.join(shipped, "order_id", "left").select(
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            (bought + F.expr("interval 1 day")).alias("order_approved_at"),
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            (bought + F.expr("interval 45 days")).alias("order_estimated_delivery_date"),
        )

    @cached_property
    def items(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(10,2)")
        freight = F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2)
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            price.alias("price"),
            freight.cast("decimal(10,2)").alias("freight_value"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(10,2)")
        paid = F.round(price * (1 - F.col("l_discount").cast("decimal(4,2)")), 2)
        kind = (
            F.when(F.col("l_returnflag") == "N", "credit_card")
            .when(F.col("l_returnflag") == "A", "boleto")
            .otherwise("voucher")
        )
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            kind.alias("payment_type"),
            F.col("l_linenumber").alias("payment_installments"),
            paid.cast("decimal(10,2)").alias("payment_value"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        scores = self.table("labels").select("doc_id", F.col("quality").alias("review_score"))
        written = F.date_add(F.lit("1998-01-01").cast("date"), (F.col("n_chars") % 365).cast("int"))
        return (
            self.table("documents")
            .join(scores, "doc_id", "left")
            .select(
                F.col("doc_id").alias("review_id"),
                F.col("doc_id").alias("order_id"),
                "review_score",
                F.col("source").alias("review_comment_title"),
                F.col("text").alias("review_comment_message"),
                written.cast("timestamp_ntz").alias("review_creation_date"),
            )
        )

    @cached_property
    def trials(self) -> DataFrame:
        """One Bernoulli trial per user and day with a view; a purchase that day converts."""
        day = F.to_date("ts").alias("event_day")
        seen = self.table("events").groupBy("user_id", day).agg(
            F.max(F.col("event_type") == "view").alias("viewed"),
            F.max(F.col("event_type") == "purchase").alias("converted"),
        )
        return seen.where("viewed").select("user_id", "event_day", "converted")

    def trial_counts(self, test_id: str) -> DataFrame:
        """Trials and conversions per variant and day."""
        arm = F.when(hash_bucket(F.col("user_id"), 10000) < 5000, "A").otherwise("B")
        return (
            self.trials.groupBy(arm.alias("variant_id"), F.col("event_day").alias("period_date"))
            .agg(
                F.count(F.lit(1)).alias("data_points"),
                F.count_if("converted").alias("conversions"),
            )
            .select(F.lit(test_id).alias("test_id"), "variant_id", "period_date", "data_points", "conversions")
        )
