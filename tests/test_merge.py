import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwork.operators import merge
from tillwork.plans import dims

T0, T1 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "a", 10, T0), (2, "b", 20, T0)], "id int, name string, n int, updated_at timestamp_ntz"
    )


def upsert(target, source):
    return merge.merge_upsert(target, source, ["id"], ["n"], touch_col="updated_at", run_ts=T1)


def test_upsert_updates_only_named_columns(spark, target, rows):
    source = spark.createDataFrame([(2, "changed", 21), (3, "c", 30)], "id int, name string, n int")
    once = upsert(target, source)
    expected = [(1, "a", 10, T0), (2, "b", 21, T1), (3, "c", 30, T1)]
    assert rows(once, "id") == expected
    assert rows(upsert(once, source), "id") == expected  # twice equals once


def test_upsert_refuses_a_repeated_key(spark, target):
    source = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], "id int, name string, n int")
    with pytest.raises(Exception, match="more than one row for a key"):
        upsert(target, source).collect()


def test_null_keys_never_match(spark, target, rows):
    source = spark.createDataFrame([(None, "x", 1), (None, "y", 2)], "id int, name string, n int")
    assert upsert(target, source).count() == 4


def test_insert_absent_is_idempotent(spark, target, rows):
    batch = spark.createDataFrame([(2, "z", 9, T1), (3, "c", 1, T1), (3, "d", 1, T1)], target.schema)
    once = merge.merge_insert_absent(target, batch, ["id"])
    assert rows(once.select("id", "name"), "id") == [(1, "a"), (2, "b"), (3, "c")]
    assert merge.merge_insert_absent(once, batch, ["id"]).count() == 3


def test_append_doubles_unless_deduplicated(target):
    assert merge.append_rows(target, target).count() == 4
    assert merge.append_rows(target, target, ["id"]).count() == 2


def test_insert_select_defaults(spark, target, rows):
    source = spark.createDataFrame([(7, 70)], "id int, n int")
    out = merge.insert_select(target, source, ["id"], {"name": "none"}).where("id = 7")
    assert rows(out) == [(7, "none", None, None)]


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_surrogate_keys_are_dense_and_extend(spark, buckets):
    df = spark.range(1000).select(F.concat(F.lit("c"), "id").alias("id"))
    keyed = merge.surrogate_key(df, "id", "key", buckets)
    stats = keyed.agg(F.min("key"), F.max("key"), F.count_distinct("key")).first()
    assert tuple(stats) == (1, 1000, 1000)
    more = keyed.unionByName(spark.range(5).select(F.concat(F.lit("n"), "id").alias("id")), allowMissingColumns=True)
    extended = merge.surrogate_key(more, "id", "key", buckets)
    assert extended.join(keyed, ["id", "key"]).count() == 1000
    assert sorted(r.key for r in extended.where(F.col("id").startswith("n")).collect()) == list(range(1001, 1006))


def test_row_key_numbers_identical_rows(spark):
    df = spark.range(100).select(F.lit(1).alias("x")).union(spark.range(50).select(F.lit(2).alias("x")))
    stats = merge.row_key(df.repartition(7), "k").agg(F.min("k"), F.max("k"), F.count_distinct("k")).first()
    assert tuple(stats) == (1, 150, 150)


def test_ab_dims_are_added_once(spark):
    first = dims.build_ab_dims(spark)
    again = dims.build_ab_dims(spark, target=first)
    assert [d.count() for d in again] == [1, 2]
    other = {**dims.COUPON_TEST, "test_id": "banner_v1"}
    tests, variants = dims.build_ab_dims(spark, other, target=first)
    assert [r.test_key for r in tests.orderBy("test_key").collect()] == [1, 2]
    assert [(r.test_key, r.variant_key) for r in variants.orderBy("variant_key").collect()] == [
        (1, 1), (1, 2), (2, 3), (2, 4),
    ]


def test_calendar_keeps_known_days(spark):
    first = dims.build_dim_date(dims.date_bounds(spark, dt.date(2016, 1, 1), dt.date(2016, 1, 3)), run_ts=T0)
    second = dims.build_dim_date(
        dims.date_bounds(spark, dt.date(2016, 1, 2), dt.date(2016, 1, 5)), target=first, run_ts=T1
    )
    assert [r.created_at for r in second.orderBy("date_key").collect()] == [T0, T0, T0, T1, T1]


def test_null_keys_conflict_with_nothing(spark, rows):
    target = spark.createDataFrame([(1, "a", T0), (None, "t", T0)], "id long, n string, updated_at timestamp_ntz")
    source = spark.createDataFrame([(None, "x"), (None, "x"), (1, "b"), (2, "c")], "id long, n string")
    merged = merge.merge_upsert(target, source, ["id"], ["n"], touch_col="updated_at", run_ts=T1)
    assert rows(merged, F.asc_nulls_first("id"), "n") == [
        (None, "t", T0), (None, "x", T1), (None, "x", T1), (1, "b", T1), (2, "c", T1)
    ]
    batch = spark.createDataFrame([(None, "x"), (None, "x"), (5, "z"), (5, "y")], "id long, n string")
    assert rows(merge.one_per_key(batch, ["id"]), F.asc_nulls_first("id")) == [(None, "x"), (None, "x"), (5, "y")]
    assert merge.merge_insert_absent(target, batch, ["id"]).count() == 5
    assert merge.require_unique(batch.where("id is null"), ["id"]).count() == 2


def test_a_touched_column_needs_a_run_time(spark):
    df = spark.createDataFrame([(1, "a", T0)], "id long, n string, updated_at timestamp_ntz")
    with pytest.raises(ValueError, match="run time"):
        merge.merge_upsert(df, df, ["id"], ["n"], touch_col="updated_at")
