"""Each branch of the business rules, on literal rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwork.functions import dates, rules, scalars
from tillwork.operators import relational as rel


def test_customer_segment(spark, rows):
    df = spark.createDataFrame(
        [(0, None, None), (1, 1, 5000.0), (2, 2, 5000.0), (3, 5, 1.0), (4, 6, 1000.0), (5, 6, 1000.01)],
        "i int, n long, spent double",
    )
    got = rows(df.select("i", rules.customer_segment(F.col("n"), F.col("spent"))), "i")
    assert [g[1] for g in got] == ["regular", "new", "returning", "returning", "regular", "vip"]


def test_seller_segment(spark, rows):
    df = spark.createDataFrame([(0, None), (1, 0), (2, 9), (3, 10), (4, 100), (5, 101)], "i int, n long")
    got = rows(df.select("i", rules.seller_segment(F.col("n"))), "i")
    assert [g[1] for g in got] == ["large", "small", "small", "medium", "medium", "large"]


def test_product_flags(spark, rows):
    df = spark.createDataFrame(
        [(0, 1000, 10, 10, 100), (1, 1001, 10, 10, 101), (2, None, None, 10, 10)],
        "i int, w int, l int, h int, d int",
    )
    flags = rules.product_flags(*[F.col(c) for c in "wlhd"])
    got = rows(df.select("i", *flags.values()), "i")
    assert got == [(0, False, False), (1, True, True), (2, None, None)]


def test_review_and_payment_flags(spark, rows):
    df = spark.createDataFrame([(0, None, 1, "voucher"), (1, "", 2, "credit_card"), (2, "ok", None, None)],
                               "i int, m string, n int, t string")
    review = rules.review_flags(F.col("m"))
    payment = rules.payment_flags(F.col("n"), F.col("t"))
    got = rows(df.select("i", *review.values(), *payment.values()), "i")
    assert got == [(0, False, 0, False, False), (1, False, 0, True, True), (2, True, 2, None, None)]


def test_dates(spark, rows):
    days = [dt.date(2016, 1, 2), dt.date(2016, 2, 29), dt.date(2018, 10, 17)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    d = F.col("d")
    got = df.orderBy("d").select(
        dates.date_key(d).alias("k"),
        dates.date_parts(d)["week"].alias("w"),
        dates.day_of_week(d).alias("dow"),
        dates.is_weekend(d).alias("we"),
        dates.month_day_names(d)["month_name"].alias("m"),
        dates.month_day_names(d, pad=False)["day_name"].alias("n"),
    ).collect()
    assert [r.k for r in got] == [20160102, 20160229, 20181017]
    assert got[0].w == 53 and [r.dow for r in got] == [6, 1, 3] and [r.we for r in got] == [True, False, False]
    assert got[0].m == "January  " and got[2].n == "Wednesday"
    back = df.select(dates.date_from_key(dates.date_key(d)).alias("x"), "d").where("x <> d")
    assert back.count() == 0


def test_month_filters_around_day_31(spark):
    keys = [19970228, 19970301, 19970330, 19970331, 19970401, 19971231, 19980101]
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    assert [r.k for r in rel.where_month_key(df, "k", 1997, 3).collect()] == [19970301, 19970330]
    assert [r.k for r in rel.where_month_key_half_open(df, "k", 1997, 3).collect()] == [
        19970301, 19970330, 19970331,
    ]
    assert [r.k for r in rel.where_month_key_half_open(df, "k", 1997, 12).collect()] == [19971231]


def test_casts(spark, rows):
    df = spark.createDataFrame([("1.5",), ("abc",), (None,)], "x string")
    assert sorted(rows(rel.coerce_numeric(df, ["x"])), key=str) == [(1.5,), (None,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rel.cast_strict(df, {"x": "double"}).collect()


def test_bad_dates_ignore_missing_delivery(spark):
    t = dt.datetime
    df = spark.createDataFrame(
        [
            (t(2017, 1, 5), t(2017, 1, 4)),  # delivered before purchase
            (t(2015, 12, 31), None),  # too early
            (t(2017, 1, 5), t(2031, 1, 1)),  # after the run date
            (t(2017, 1, 5), None),
            (t(2017, 1, 5), t(2017, 1, 6)),
        ],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert rel.where_bad_dates(df, "a", "b", dt.date(2016, 1, 1), dt.date(2020, 1, 1)).count() == 3


def test_formats_and_rates(spark):
    one = spark.range(1).select(
        scalars.money(F.lit("2358287.54").cast("decimal(12,2)")).alias("money"),
        scalars.whole(F.lit(27073)).alias("whole"),
        scalars.pct(F.lit("54.63").cast("decimal(5,2)")).alias("pct"),
        scalars.rate_pct(F.lit(27073), F.lit(49556)).alias("a"),
        scalars.rate_pct(F.lit(27878), F.lit(49885)).alias("b"),
        scalars.rate_pct(F.lit(1), F.lit(0)).alias("none"),
        F.round(scalars.normal_cdf(F.lit(1.959964)), 5).alias("cdf"),
    ).first()
    assert (one.money, one.whole, one.pct) == ("2,358,287.54", "27,073", "54.6%")
    assert (one.a, one.b, one.none) == (Decimal("54.63"), Decimal("55.88"), None)
    assert one.cdf == 0.975
