"""Loads: operational tables to stored dimensions and facts, all at once or batch by batch.

Every dimension is written before a fact reads it, so the facts scan small
stored tables and a lost executor never rebuilds a dimension.  Facts are laid
out by the month of their date key: monthly queries read one month, and a
batch rewrites the months that it touches.  Each table changes by a whole version at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork import catalog
from tillwork.functions.dates import key_of
from tillwork.operators.experiment import exposure_events, key_of_test
from tillwork.operators.joins import not_exists
from tillwork.operators.keymap import KeyMap
from tillwork.plans import dims, facts, orderbook
from tillwork.sources.files import keep, publish, scan_published, versions
from tillwork.sources.months import MONTH, MonthlyTable


class Warehouse:
    """Stored star tables below one folder: dimensions as published versions, facts by month."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._facts: dict[str, MonthlyTable] = {}

    def table_path(self, name: str) -> str:
        return f"{self.path}/{name}"

    def fact(self, name: str) -> MonthlyTable:
        if name not in self._facts:
            self._facts[name] = MonthlyTable(self.spark, self.table_path(name), catalog.FACT_DATE_KEY[name])
        return self._facts[name]

    def exists(self, name: str) -> bool:
        if name in catalog.FACT_DATE_KEY:
            return self.fact(name).exists()
        return bool(versions(self.spark, self.table_path(name)))

    def read(self, name: str) -> DataFrame:
        if name in catalog.FACT_DATE_KEY:
            return self.fact(name).read()
        return scan_published(self.spark, self.table_path(name))

    def write(self, name: str, df: DataFrame, conform: bool = True, number: str | None = None) -> DataFrame:
        """Replace one table; ``df`` may read the version before.

        Without ``conform`` the columns and types of ``df`` are stored as they are.  ``number`` names
        the key by which the rows of a fact are numbered.
        """
        rows = catalog.conform(df, name) if conform else df
        if name in catalog.FACT_DATE_KEY:
            return self.fact(name).replace(rows, number)
        known = versions(self.spark, self.table_path(name))
        publish(rows, self.table_path(name), known[-1][0] + 1 if known else 1)
        return self.read(name)

    def merge(
        self,
        name: str,
        df: DataFrame,
        keys: Sequence[str],
        number: str,
        updates: Sequence[str] = (),
        everywhere: bool = False,
        fixed: bool = False,
    ) -> DataFrame:
        """Add to a fact the rows whose key it lacks; see ``MonthlyTable.merge``."""
        return self.fact(name).merge(catalog.conform(df, name), keys, number, updates, everywhere, fixed)

    def month(self, name: str, year: int, month: int) -> DataFrame:
        """One month of a fact: a partition filter, so other months are not read."""
        return self.read(name).where(F.col(MONTH) == year * 100 + month)

    def keys(self, dim: str) -> KeyMap:
        """The key map of dim_customer, dim_product or dim_seller."""
        entity = dim.removeprefix("dim_")
        return KeyMap(self.spark, f"{self.path}/keys/{entity}", f"{entity}_id", f"{entity}_key")


DECLARED = ["status_key", "approved_date_key", "delivered_date_key", "estimated_delivery_date_key", "unique_sellers"]


def bulk_load(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    path: str,
    run_ts: dt.datetime,
    test: Mapping[str, Any] = dims.COUPON_TEST,
    calendar: tuple[dt.date, dt.date] | None = None,
) -> Warehouse:
    """Build and store the whole star, in an empty folder.  ``calendar`` overrides the range of dates in the facts."""
    return load_batch(Warehouse(spark, path), tables, run_ts, test=test, calendar=calendar)


def load_batch(
    wh: Warehouse,
    tables: Mapping[str, DataFrame],
    run_ts: dt.datetime,
    since: dt.date | None = None,
    until: dt.date | None = None,
    test: Mapping[str, Any] = dims.COUPON_TEST,
    calendar: tuple[dt.date, dt.date] | None = None,
) -> Warehouse:
    """Load the orders bought from ``since`` on and before ``until``, and what belongs to them.

    ``tables`` are the whole operational tables (of orders, those up to the last one of the batch are
    enough).  Dimensions refresh; facts get the rows that they lack and orders their later dates, in the
    months that the batch touches.  Loading a batch again, or one that overlaps others, adds nothing.
    Identifiers are stored as strings.
    """
    spark = wh.spark
    bought = F.col(facts.BOUGHT)
    orders = tables["orders"]
    if until is not None:
        orders = orders.where(bought < F.lit(until).cast("timestamp_ntz"))
    first = key_of(since) if since is not None else 0
    customers, items = tables["customers"], tables["order_items"]
    payments, reviews = tables["order_payments"], tables["order_reviews"]
    stamp = F.lit(run_ts).cast("timestamp_ntz").alias("created_at")

    def stored(name: str) -> DataFrame | None:
        return wh.read(name) if wh.exists(name) else None

    def dim(name: str, build, source: DataFrame, *more: DataFrame, **given: DataFrame) -> DataFrame:
        target = stored(name)
        if target is not None:
            # the stored identifier is a string
            natural = wh.keys(name).natural[0]
            target = target.withColumn(natural, F.col(natural).cast(source.schema[natural].dataType))
        return wh.write(name, build(source, *more, target=target, run_ts=run_ts, keys=maps[name], **given))

    # stored identifiers are strings, but facts join on them as they come, with the key maps, wherever all tables
    # agree on the type: numbers are narrower
    def alike(name: str, *frames: DataFrame) -> list[DataFrame]:
        if len({df.schema[name].dataType for df in frames}) == 1:
            return list(frames)
        return [df.withColumn(name, F.col(name).cast("string")) for df in frames]

    sources = {"dim_customer": customers, "dim_product": tables["products"], "dim_seller": tables["sellers"]}
    maps = {name: wh.keys(name).extend(source) for name, source in sources.items()}
    orders, items, payments, reviews = alike("order_id", orders, items, payments, reviews)
    orders, customer_ids = alike("customer_id", orders, maps["dim_customer"])
    items, product_ids = alike("product_id", items, maps["dim_product"])
    items, seller_ids = alike("seller_id", items, maps["dim_seller"])
    # the one time that orders meet their customers, and items and payments their orders
    orders = keep(orders.join(facts.keys_of(customer_ids, "customer"), "customer_id", "left"), "orders")
    unique = orderbook.is_unique(orders)
    lines = keep(orderbook.sold_lines(items, orders, product_ids, seller_ids), "lines")
    paid = keep(orderbook.paid_lines(payments, orders), "paid")

    bounds = dims.date_bounds(spark, *calendar) if calendar else dims.date_range(orders, reviews)
    wh.write("dim_date", dims.build_dim_date(bounds, stored("dim_date"), run_ts=run_ts))
    statuses = wh.write("dim_order_status", dims.build_dim_order_status(spark))
    customer = dim("dim_customer", dims.build_dim_customer, customers, orders, payments, stats=orderbook.paid_by_customer(paid))
    dim("dim_product", dims.build_dim_product, tables["products"])
    seller = dim("dim_seller", dims.build_dim_seller, tables["sellers"], items, orders, stats=orderbook.sold_by_seller(lines))

    def of_batch(df: DataFrame, when: Column) -> DataFrame:
        return df.where(when >= F.lit(since).cast("timestamp_ntz")) if since is not None else df

    batch = of_batch(orders, bought)
    # sales without a date stay out
    sales = orderbook.build_fact_sales(lines).where(F.col("order_date_key") >= first)
    sales = wh.merge("fact_sales", sales.withColumn("created_at", stamp), ["order_id", "order_item_id"], "sale_key", fixed=True)

    dated = {"order_approved_at", "order_delivered_customer_date", "order_estimated_delivery_date"} <= set(orders.columns)
    declared = DECLARED if dated else []
    # lines of an id that several orders share would be summed several times
    book = orderbook.line_book(batch, of_batch(lines, F.col(orderbook.DAY))) if unique else orderbook.order_book(batch, items, payments)
    fact_orders = orderbook.build_fact_orders(book, None, statuses if dated else None, unique)
    wh.merge("fact_orders", fact_orders.withColumn("created_at", stamp), ["order_id"], "order_key", updates=declared)

    paid = orderbook.build_fact_payments(of_batch(paid, F.col(orderbook.DAY))).withColumn("created_at", stamp)
    wh.merge("fact_payments", paid, ["order_id", "payment_sequential"], "payment_key", fixed=True)
    # a review may come long after its order, so all of them are looked at
    ids = (customer_ids, product_ids, seller_ids)
    # which orders these are is settled first: where they are few, the items are cut as they are read, once
    asked = keep(facts.reviewed_orders(reviews, stored("fact_reviews")), "reviewed")
    cut = items.select("order_id", "product_id", "seller_id").join(asked, "order_id", "left_semi")
    reviewed = facts.build_fact_reviews(reviews, orders, keep(cut, "reviewed-items"), *ids, reviewed=asked)
    reviewed = wh.merge("fact_reviews", reviewed.withColumn("created_at", stamp), ["review_id", "order_id"], "review_key")
    ratings = dims.seller_avg_rating(reviewed)
    seller = wh.write("dim_seller", seller.drop("avg_rating").join(ratings, "seller_key", "left"))

    targets = (stored("dim_ab_test"), stored("dim_test_variant"))
    target = targets if targets[0] is not None else None
    tests, variants = dims.build_ab_dims(spark, test, start_date=run_ts.date(), run_ts=run_ts, target=target)
    tests, variants = wh.write("dim_ab_test", tests), wh.write("dim_test_variant", variants)
    last_day = dims.purchase_range(orders).select("end_date").scalar()
    # a customer is exposed to a test once, in the month of the load that saw them first
    if (exposed := stored("fact_ab_test_events")) is not None:
        exposed = exposed.where(F.col("test_key") == key_of_test(tests, test["test_id"]))
        narrow = customer.select("customer_key", "customer_id", "total_orders")
        customer = keep(not_exists(narrow, exposed, ["customer_key"]), "unexposed")
        if customer.isEmpty():
            return wh
    events = exposure_events(customer, sales, tests, variants, last_day, test["test_id"]).withColumn("created_at", stamp)
    wh.merge("fact_ab_test_events", events, ["customer_key", "test_key"], "event_key", everywhere=True)
    return wh
