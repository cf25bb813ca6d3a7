"""One key holds a third of the rows: results stay whole, and work is split."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwork.operators import joins, quality, windows


@pytest.fixture(scope="module")
def hot_orders(spark):
    """3000 orders; customer 0 has a third of them, ties in time included."""
    customer = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1)
    base = F.lit(dt.datetime(2017, 1, 1)).cast("timestamp_ntz")
    ts = F.when(F.col("id") % 101 != 0, F.timestamp_add("MINUTE", ((F.col("id") * 37) % 5000).cast("int"), base))
    return spark.range(3000).select(
        F.col("id").alias("order_id"), customer.alias("customer_id"), ts.cast("timestamp_ntz").alias("ts")
    )


def test_rank_of_a_hot_customer(hot_orders):
    got = windows.order_rank(hot_orders, "customer_id", "ts", "order_id", "r")
    plain = Window.partitionBy("customer_id").orderBy(F.asc_nulls_last("ts"), "order_id")
    want = hot_orders.select("order_id", F.row_number().over(plain).alias("want"))
    assert got.count() == 3000
    assert got.join(want, "order_id").where("r <> want").count() == 0


def test_orders_without_a_time_are_spread(spark):
    """One customer with all orders, none of them with a time: ranked in ranges, none of which is large."""
    off = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        none = F.lit(None).cast("timestamp_ntz")
        orders = spark.range(40_000).select(F.lit(7).alias("c"), F.col("id").alias("o"), none.alias("ts")).repartition(5)
        ranged = windows._ranges(orders, ["c", F.asc_nulls_last("ts"), "o"])
        sizes = [r["count"] for r in ranged.groupBy("__part").count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8
        got = windows.order_rank(orders, "c", "ts", "o", "r")
        assert got.where("r <> o + 1").count() == 0 and got.count() == 40_000
        nulls = windows.running_number(orders.select(F.lit(None).cast("int").alias("k"), "o"), ["k"], ["o"], "r")
        assert nulls.where("r = o + 1").count() == 40_000
    finally:
        for k in off:
            spark.conf.unset(k)


def test_one_row_many_times(spark, monkeypatch):
    """A table that is one row over and over: counted, and its repeats laid out in pieces."""
    monkeypatch.setattr(windows, "COPIES", 1000)
    df = spark.range(50_000).select(F.lit(1).alias("k"), F.lit("v").alias("v"), F.lit(None).cast("int").alias("n"))
    got = windows.dupe_rows(df, ["k"], ["v"])
    assert got.count() == 49_999 and got.distinct().count() == 1
    per_task = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 25_000
    assert windows.dupe_rows(df.limit(1), ["k"], ["v"]).count() == 0


def test_first_orders_equal_rank_one(hot_orders):
    first = windows.first_orders(hot_orders, "customer_id", "ts", "order_id")
    ranked = windows.order_rank(hot_orders, "customer_id", "ts", "order_id", "r").where("r = 1")
    assert first.count() == ranked.count() == ranked.join(first, "order_id").count()


def test_dupe_rows_with_copies(spark):
    """1000 identical rows: all but one are repeats."""
    df = (
        spark.range(1000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
        .union(spark.range(10).select(F.lit(2), F.col("id").cast("string")))
        .repartition(6)
    )
    got = windows.dupe_rows(df, ["k"], ["v"]).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in got} == {1: 999, 2: 9}
    kept = windows.dupe_rows(df, ["k"], ["v"]).where("k = 2")
    assert kept.where("v = '0'").count() == 0  # the first stays


def test_fan_out_equals_left_join(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, x string")
    right = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (None, 99)], "k int, y int")
    got = sorted(rows(joins.fan_out(left, right, "k").select("k", "x", "y")), key=str)
    want = sorted(rows(left.join(right, "k", "left").select("k", "x", "y")), key=str)
    assert got == want


def test_fk_counts_rows_not_references(spark):
    child = spark.createDataFrame([(9,)] * 500 + [(1,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    strict = quality.check_fk(child, "fk", parent, "pk", "c").first()
    lenient = quality.check_fk(child, "fk", parent, "pk", "c", nulls_allowed=True).first()
    assert (strict.violations, lenient.violations) == (501, 500)


def test_adaptive_execution_splits_a_hot_join_key(spark):
    """With small limits in place the star join shows a skew-split sort-merge join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.rand(1).alias("v")
        )
        right = spark.range(0, 60000, 1, 8).select(F.col("id").alias("k"), F.lit("x").alias("name"))
        joined = joins.resolve_dims(left, [(right, "k")])
        assert len(joined.collect()) == 60000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
