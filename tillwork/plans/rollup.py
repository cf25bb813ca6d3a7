"""Monthly totals of stored sales from which any range of months is summed up.

Revenue, lines and orders add up, as an order has one purchase date.  Customers do not: they are kept as
bitmap pages, which are merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.pages import distinct_counts, distinct_pages
from tillwork.plans.report import with_ratios
from tillwork.plans.warehouse import Warehouse
from tillwork.sources.files import delete, sink_overwrite, versions
from tillwork.sources.months import MONTH

SCHEMA = f"page long, bits binary, value decimal(38,2), orders long, lines long, {MONTH} int"
VERSION = "version="


class SalesRollup:
    """Totals and customer pages of ``fact_sales``, month by month beside the fact.

    They carry the fact's version of their month, so a refresh reads the months that loads have changed
    since and no others, and a refresh that breaks off is done again.  Readers see a month only in the version
    that the fact has now; one that is not refreshed yet is an error, not an old number.
    """

    def __init__(self, wh: Warehouse):
        self.spark, self.fact, self.path = wh.spark, wh.fact("fact_sales"), wh.table_path("rollup_sales")

    def _whole(self) -> dict[int, str]:
        return dict(versions(self.spark, self.path, VERSION))

    def refresh(self) -> list[int]:
        """Sum up the months of fact versions without totals; which versions those were."""
        now = self.fact.versions_by_month()
        whole = self._whole()
        missing = sorted(set(now.values()) - set(whole))
        for version in missing:
            rows = self.fact.months([month for month, of in now.items() if of == version])
            sink_overwrite(self._summed(rows), f"{self.path}/{VERSION}{version}", [MONTH])
        for version in set(whole) - set(now.values()):
            delete(self.spark, whole[version])
        return missing

    def _summed(self, sales: DataFrame) -> DataFrame:
        """A row of totals and the customer pages of each month; sales without a date are a month of their own.

        Money and lines add up where they are read; only the bare ids of orders move, to be counted.
        """
        sums = sales.groupBy(MONTH).agg(F.sum("total_value").alias("value"), F.count(F.lit(1)).alias("lines"))
        counted = sales.select(MONTH, "order_id").distinct().groupBy(MONTH).agg(F.count("order_id").alias("orders"))
        # by a union, as sales without a date are a month too
        totals = sums.unionByName(counted, allowMissingColumns=True).groupBy(MONTH).agg(
            F.sum("value").cast("decimal(38,2)").alias("value"),
            F.sum("orders").alias("orders"),
            F.sum("lines").alias("lines"),
        )
        return totals.unionByName(distinct_pages(sales, "customer_key", MONTH), allowMissingColumns=True)

    def read(self) -> DataFrame:
        now = self.fact.versions_by_month()
        if late := set(now.values()) - set(self._whole()):
            raise ValueError(f"versions {sorted(late)} of the sales are not summed up: refresh first")
        part = {None: "__HIVE_DEFAULT_PARTITION__"}
        folders = [f"{self.path}/{VERSION}{version}/{MONTH}={part.get(month, month)}" for month, version in now.items()]
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(f"{SCHEMA}, version int").option("basePath", self.path).parquet(*folders).drop("version")

    def by_month(self) -> DataFrame:
        """Totals and ratios of every month with dated sales."""
        rows = self.read().where(F.col(MONTH).isNotNull())
        customers = distinct_counts(rows.where("page is not null"), "unique_customers", MONTH)
        year, month = (F.col(MONTH) / 100).cast("int"), F.col(MONTH) % 100
        # a month in which nobody has a key has no page
        found = with_ratios(_totals(rows, MONTH).join(customers, MONTH, "left").fillna(0, ["unique_customers"]))
        return found.select(year.alias("year"), month.cast("int").alias("month"), *[c for c in found.columns if c != MONTH])

    def over(self, first: int, last: int) -> DataFrame:
        """Totals and ratios of the months ``first`` to ``last`` (yyyymm, both included), one row.

        A customer of several months counts once.  Only those months' files are opened.
        """
        rows = self.read().where(F.col(MONTH).between(first, last))
        customers = distinct_counts(rows.where("page is not null"), "n").scalar()
        return with_ratios(_totals(rows).withColumn("unique_customers", customers))


def _totals(rows: DataFrame, *by: str) -> DataFrame:
    zero = F.lit(0)
    return rows.where("page is null").groupBy(*by).agg(
        F.coalesce(F.sum("value"), zero).cast("decimal(20,2)").alias("total_revenue"),
        F.coalesce(F.sum("orders"), zero).alias("total_orders"),
        F.coalesce(F.sum("lines"), zero).alias("total_line_items"),
    )
