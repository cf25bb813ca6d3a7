"""The star of a sample folder, stored once per session and read by many queries.

Reports and experiments work on stored dimensions and facts, as they do after
a bulk load: the load is paid once, and a month's report opens one month.
Each table is written to the shared folder when a query first needs it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.plans import dims, facts
from tillwork.plans.warehouse import Warehouse
from tillwork.session import work_path
from tillwork.sources.retail import Retail
from tillwork.suite.parts import MONTH_END, MONTH_START


class StoredStar:
    def __init__(self, retail: Retail, month: bool):
        self.stored = Warehouse(retail.spark, work_path(retail.spark, "star"))
        self.retail, self.only_month = retail, month
        self.written: set[str] = set()
        self.builders: dict[str, Callable[[], DataFrame]] = {
            "dim_customer": lambda: dims.build_dim_customer(retail.customers, self.orders, retail.payments),
            "dim_product": lambda: dims.build_dim_product(retail.products),
            "dim_seller": lambda: dims.build_dim_seller(retail.sellers, retail.items, self.orders),
            "fact_sales": lambda: facts.build_fact_sales(
                retail.items,
                self.orders,
                self.read("dim_customer"),
                self.read("dim_product"),
                self.read("dim_seller"),
            ),
        }

    @cached_property
    def orders(self) -> DataFrame:
        if not self.only_month:
            return self.retail.orders
        bought = F.col("order_purchase_timestamp")
        first, after = (F.lit(d).cast("timestamp_ntz") for d in (MONTH_START, MONTH_END))
        return self.retail.orders.where((bought >= first) & (bought < after))

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored table, written by ``build`` when it is first asked for."""
        if name not in self.written:
            self.stored.write(name, build(), conform=False)
            self.written.add(name)
        return self.stored.read(name)

    def read(self, name: str) -> DataFrame:
        return self.keep(name, self.builders[name])

    def month(self, name: str, year: int, month: int) -> DataFrame:
        self.read(name)
        return self.stored.month(name, year, month)


_stars: dict[tuple[str, str, bool], StoredStar] = {}


def stored_star(retail: Retail, month: bool = False) -> StoredStar:
    """The stored star of the folder, over all orders or those of the sample month."""
    key = (retail.spark.sparkContext.applicationId, retail.sf_dir, month)
    if key not in _stars:
        _stars[key] = StoredStar(retail, month)
    return _stars[key]
