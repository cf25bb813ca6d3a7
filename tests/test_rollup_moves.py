"""What a refresh of the monthly totals moves."""

import re

from tillwork.plans.rollup import SalesRollup
from tillwork.plans.warehouse import Warehouse
from tillwork.session import work_path
from tillwork.sources.files import keep

SCHEMA = "order_id string, customer_key long, order_date_key int, total_value decimal(12,2), date_month int"


def test_orders_move_as_bare_ids(spark):
    """Money and lines are summed where they lie; an order without an id and a month without a date count as before."""
    rows = [("a", 1, 20200105, 202001), ("a", 1, 20200105, 202001), (None, 2, 20200106, 202001), ("b", None, None, None), ("b", 1, None, None)]
    sales = keep(spark.createDataFrame([(*r[:3], None, r[3]) for r in rows], SCHEMA).selectExpr("order_id", "customer_key", "order_date_key", "cast(2.5 as decimal(12,2)) as total_value", "date_month"), "sales")
    summed = SalesRollup(Warehouse(spark, work_path(spark, "rollup")))._summed(sales)
    got = sorted((str(r.date_month), float(r.value), r.orders, r.lines) for r in summed.collect() if r.page is None)
    assert got == [("202001", 7.5, 1, 3), ("None", 5.0, 1, 2)]
    plan = spark._jvm.PythonSQLUtils.explainString(summed._jdf.queryExecution(), "formatted")
    moved = re.findall(r"^\(\d+\) Exchange *\nInput \[\d+\]: \[([^\]]*)\]", plan, re.M)
    by_order = [columns for columns in moved if "order_id" in columns]
    assert by_order and not any("sum" in columns or "count" in columns for columns in by_order)
