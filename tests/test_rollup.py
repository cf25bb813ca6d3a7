"""Bitmap pages against direct distinct counts, and which months a refresh reads."""

import random

import pytest
from pyspark.sql import functions as F

from tillwork.operators.pages import distinct_counts, distinct_pages, merged_pages
from tillwork.plans.rollup import SalesRollup
from tillwork.plans.warehouse import Warehouse
from tillwork.session import work_path
from tillwork.sources.files import keep

SCHEMA = "order_id string, customer_key long, order_date_key int, total_value decimal(12,2)"


def test_pages_equal_direct_counts(spark):
    draw = random.Random(5)
    # keys on both sides of the borders of pages, below zero, repeated and missing
    keys = [None, 0, -1, 1, 32767, 32768, 32769, 65536, 1 << 40, *range(100_000, 100_050)]
    rows = [(draw.choice("ab"), draw.choice("xyz"), draw.choice(keys)) for _ in range(800)]
    df = spark.createDataFrame(rows, "g string, h string, k long")
    pages = distinct_pages(df, "k", "g", "h")
    for by in (("g", "h"), ("g",), ()):
        want = df.groupBy(*by).agg(F.count_distinct("k").alias("n")).collect()
        assert sorted(map(tuple, distinct_counts(pages, "n", *by).collect())) == sorted(map(tuple, want))
    # merged pages merge again
    assert distinct_counts(merged_pages(pages, "g"), "n").first().n == len({k for _, _, k in rows} - {None})
    assert distinct_counts(pages.where("false"), "n").first().n == 0
    assert distinct_pages(spark.createDataFrame([("a", None)], "g string, k long"), "k", "g").count() == 0


def sale(order, customer, day, value):
    return (order, customer, day, value)


@pytest.fixture
def wh(spark):
    wh = Warehouse(spark, work_path(spark, "rollup"))
    rows = [sale("a", 1, 20200105, 2), sale("a", 1, 20200105, 3), sale("b", 1, 20200201, 5), sale("c", 2, 20200220, 7),
            sale("d", None, 20200301, 1), sale("n", 9, None, 100)]
    wh.fact("fact_sales").merge(data(spark, rows), ["order_id"])
    return wh


def data(spark, rows):
    from decimal import Decimal

    return keep(spark.createDataFrame([(*r[:3], Decimal(r[3])) for r in rows], SCHEMA), "sales")


def figures(df):
    return [(float(r.total_revenue), r.total_orders, r.total_line_items, r.unique_customers) for r in df.collect()]


def test_ranges(wh):
    rollup = SalesRollup(wh)
    with pytest.raises(ValueError, match="refresh first"):
        rollup.read()
    assert rollup.refresh() == [1] and rollup.refresh() == []
    assert figures(rollup.by_month().orderBy("month")) == [(5, 1, 2, 1), (12, 2, 2, 2), (1, 1, 1, 0)]
    # customer 1 of both months counts once
    assert figures(rollup.over(202001, 202002)) == [(17, 3, 4, 2)]
    assert figures(rollup.over(201901, 201912)) == [(0, 0, 0, 0)]
    assert (r := rollup.over(201901, 201912).first()).avg_order_value == 0 and r.revenue_per_customer == 0


def test_a_refresh_reads_changed_months_only(spark, wh):
    rollup = SalesRollup(wh)
    rollup.refresh()
    wh.fact("fact_sales").merge(data(spark, [sale("e", 3, 20200210, 4), sale("f", 1, 20200401, 6)]), ["order_id"])
    with pytest.raises(ValueError, match="refresh first"):
        rollup.by_month()
    read = []
    months = rollup.fact.months
    rollup.fact.months = lambda some: read.append(sorted(some)) or months(some)
    assert rollup.refresh() == [2] and read == [[202002, 202004]]
    assert figures(rollup.by_month().orderBy("month")) == [(5, 1, 2, 1), (16, 3, 3, 3), (1, 1, 1, 0), (6, 1, 1, 1)]
    assert figures(rollup.over(202001, 202004)) == [(28, 6, 7, 3)]


def test_a_broken_refresh_is_done_again(wh):
    import os

    rollup = SalesRollup(wh)
    rollup.refresh()
    os.remove(f"{rollup.path.removeprefix('file:')}/version=1/_SUCCESS")
    assert rollup.refresh() == [1] and figures(rollup.over(202001, 202002)) == [(17, 3, 4, 2)]


def test_no_distinct_count_over_rows(wh):
    rollup = SalesRollup(wh)
    rollup.refresh()
    for df in (rollup.by_month(), rollup.over(202001, 202002)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan and "order_id" not in plan


def test_empty_fact(spark):
    wh = Warehouse(spark, work_path(spark, "rollup"))
    wh.fact("fact_sales").merge(data(spark, [sale("a", 1, 20200105, 2)]).where("false"), ["order_id"])
    rollup = SalesRollup(wh)
    assert rollup.refresh() == [] and rollup.by_month().count() == 0 and figures(rollup.over(202001, 202002)) == [(0, 0, 0, 0)]
