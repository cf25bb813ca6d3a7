"""Key maps, monthly tables and loads in batches: what is read, what a broken load leaves, what stays."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillwork import catalog
from tillwork.operators import bayes, quality
from tillwork.operators.keymap import KeyMap
from tillwork.plans import dims
from tillwork.session import work_path
from tillwork.sources import files, months
from tillwork.sources.months import MonthlyTable

RUN = dt.datetime(2020, 1, 1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_key_never_changes(spark):
    path = work_path(spark, "keys")
    first = spark.createDataFrame([(i % 50 if i % 7 else None, i) for i in range(400)], "id long, x int")
    once = {r.id: r.key for r in KeyMap(spark, path, "id", "key").extend(first).collect()}
    assert sorted(once) == list(range(50)) and sorted(once.values()) == list(range(1, 51))
    assert KeyMap(spark, path, "id", "key").extend(first.where("false")).count() == 50
    more = spark.range(30, 90).toDF("id")
    twice = {r.id: r.key for r in KeyMap(spark, path, "id", "key").extend(more).collect()}
    assert all(twice[i] == k for i, k in once.items()) and sorted(twice.values()) == list(range(1, 91))
    # a batch that broke off does not count, and its number is given again
    spark.createDataFrame([(999, 91)], "id long, key long").write.parquet(f"{path}/v=3")
    os.remove(f"{path}/v=3/_SUCCESS")
    assert KeyMap(spark, path, "id", "key").read().count() == 90
    again = KeyMap(spark, path, "id", "key").extend(spark.range(100).toDF("id"))
    assert sorted(r.key for r in again.collect()) == list(range(1, 101)) and again.where("id = 999").count() == 0


def test_empty_map(spark):
    keys = KeyMap(spark, work_path(spark, "keys"), ["a", "b"], "key")
    assert keys.read() is None
    assert keys.extend(spark.createDataFrame([], "a long, b string")).count() == 0
    assert [tuple(r) for r in keys.extend(spark.createDataFrame([(1, "x"), (1, None)], "a long, b string")).collect()] == [(1, 1, "x")]
    assert keys.read().where("key = 1").count() == 1


def test_dim_customer_reads_its_input_once(retail):
    keys = KeyMap(retail.spark, work_path(retail.spark, "keys"), "customer_id", "customer_key").extend(retail.customers)
    dim = dims.build_dim_customer(retail.customers, retail.orders, retail.payments, run_ts=RUN, keys=keys)
    plan = plan_of(dim)
    assert [plan.count(c) for c in ("c_name#", "o_orderdate#", "l_extendedprice#")] != [0, 0, 0]
    assert plan.count("Relation [c_custkey") == plan.count("Relation [o_orderkey") == plan.count("Relation [l_orderkey") == 1
    merged = dims.build_dim_customer(retail.customers, retail.orders, retail.payments, files.keep(dim, "dim"), RUN, keys)
    # source rows with and without an id, and each once
    assert plan_of(merged).count("Relation [l_orderkey") <= 2


def saved(spark, n):
    store = files.empty_table(spark, catalog.ANALYTICS["bayesian_priors_store"])
    for i in range(n):
        rows = spark.createDataFrame([("t", v, dt.date(2020, 1 + i, 1), 2.0 + i, 3.0, 5, 1) for v in "AB"], "test_id string, variant_id string, period_date date, alpha_value double, beta_value double, data_points long, conversions long")
        store = bayes.save_posterior(store, rows, RUN)
    return store


def test_saves_keep_a_constant_plan(spark):
    once, fourth = saved(spark, 1), saved(spark, 4)
    assert plan_of(fourth).count("Join") == plan_of(once).count("Join") == 0
    assert plan_of(fourth).count("Relation") == plan_of(once).count("Relation") == 1
    assert sorted(r.prior_id for r in fourth.collect()) == list(range(1, 9))
    again = bayes.save_posterior(fourth, fourth.drop("value_type", "calculation_method", "notes", "created_at"), RUN)
    ids = {(r.variant_id, r.period_date): r.prior_id for r in fourth.collect()}
    assert {(r.variant_id, r.period_date): r.prior_id for r in again.collect()} == ids


SCHEMA = "k long, order_id string, day int, v int"


@pytest.fixture
def sales(spark):
    table = MonthlyTable(spark, work_path(spark, "sales"), "day")
    rows = [(None, "a", 20200105, 1), (None, "b", 20200106, 2), (None, "c", 20200201, 3), (None, "n", None, 4)]
    table.merge(spark.createDataFrame(rows, SCHEMA), ["order_id"], "k")
    return table


def content(table):
    return sorted((r.order_id, r.day, r.v) for r in table.read().collect())


def test_only_touched_months_are_read_and_written(spark, sales):
    batch = spark.createDataFrame([(None, "c", 20200201, 30), (None, "d", 20200203, 5), (None, "e", 20200301, 6), (None, "m", None, 7)], SCHEMA)
    keys = {r.order_id: r.k for r in sales.read().collect()}
    plan = sales.months([202002, 202003, None])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(date_month" in plan and "202002" in plan and "202001" not in plan.split("PartitionFilters")[1].split("]")[0]
    sales.merge(batch, ["order_id"], "k")
    assert content(sales) == [("a", 20200105, 1), ("b", 20200106, 2), ("c", 20200201, 3), ("d", 20200203, 5), ("e", 20200301, 6), ("m", None, 7), ("n", None, 4)]
    after = {r.order_id: r.k for r in sales.read().collect()}
    assert keys.items() <= after.items() and sorted(after.values()) == list(range(1, 8))
    assert {r.month: r.version for r in sales._pointer()[1]} == {202001: 1, 202002: 2, 202003: 2, None: 2}
    sales.merge(batch, ["order_id"], "k")  # again
    assert len(content(sales)) == 7 and {r.order_id: r.k for r in sales.read().collect()} == after
    sales.merge(batch, ["order_id"], "k", updates=["v"])
    assert ("c", 20200201, 30) in content(sales) and {r.order_id: r.k for r in sales.read().collect()} == after
    # versions that no kept pointer names are gone
    assert {n for n, _ in files.versions(spark, f"{sales.path}/data", "version=")} == {1, 3, 4}


def test_all_months_are_compared_on_request(spark, sales):
    batch = spark.createDataFrame([(None, "a", 20200501, 9), (None, "z", 20200501, 9)], SCHEMA)
    sales.merge(batch, ["order_id"], "k", everywhere=True)
    assert [r[0] for r in content(sales)] == ["a", "b", "c", "n", "z"]


def test_a_broken_load_leaves_the_old_table(spark, sales, monkeypatch):
    before = content(sales)
    batch = spark.createDataFrame([(None, "c2", 20200202, 8), (None, "f", 20200401, 8)], SCHEMA)

    def broken(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(months, "publish", broken)
        with pytest.raises(RuntimeError):
            sales.merge(batch, ["order_id"], "k")
    other = MonthlyTable(spark, sales.path, "day")
    assert content(other) == before and len(files.versions(spark, f"{sales.path}/data", "version=")) == 2
    other.merge(batch, ["order_id"], "k")
    assert len(content(other)) == len(before) + 2
    # a reader that opened the table before still finds its files
    assert content(sales) == content(other)


def test_replace_and_empty(spark, sales):
    sales.replace(spark.createDataFrame([(None, "x", 20210101, 1)], SCHEMA), "k")
    assert content(sales) == [("x", 20210101, 1)]
    empty = MonthlyTable(spark, work_path(spark, "empty"), "day")
    with pytest.raises(FileNotFoundError):
        empty.read()
    empty.merge(spark.createDataFrame([], SCHEMA), ["order_id"], "k")
    assert empty.read().count() == 0
    empty.merge(spark.createDataFrame([(None, "x", 20210101, 1)], SCHEMA), ["order_id"], "k")
    assert [r.k for r in empty.read().collect()] == [1]
    empty.merge(spark.createDataFrame([], SCHEMA), ["order_id"], "k")
    assert content(empty) == [("x", 20210101, 1)]


def test_repeated_rows_of_a_new_key_all_come_in(spark, sales):
    sales.merge(spark.createDataFrame([(None, "q", 20200105, 1)] * 3 + [(None, "a", 20200105, 1)], SCHEMA), ["order_id"], "k")
    assert [r[0] for r in content(sales)] == ["a", "b", "c", "n", "q", "q", "q"]
    assert sales.read().agg(F.count_distinct("k")).first()[0] == 7


def test_a_table_is_read_once_for_all_its_checks(spark):
    """Every table of the star is scanned once, and there is one aggregation of values."""
    tables = {}
    for name, schema in catalog.ANALYTICS.items():
        path = work_path(spark, "star-table")
        spark.createDataFrame([], schema).write.parquet(path)
        tables[name] = spark.read.parquet(path)
    report = quality.star_report(tables)
    assert plan_of(report).count("Relation [") == len(tables) == 13
    assert report.where("not passed").count() == 0 and report.count() > 60
