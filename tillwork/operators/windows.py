"""Ranking and de-duplication that hold up when one key owns much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.sources.files import keep

#: copies of one row that are laid out together
COPIES = 1 << 16

def _ranges(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``df`` in ranges of the whole ``order``, stored: ``__part`` says which.

    The ranges follow the order, whatever share of the rows a key has.  Storing them fixes what each
    holds, so that a lost task finds the same.
    """
    return keep(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges")


def running_number(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    """1, 2, 3 ... per key in ``order``, where a key may own any share of the rows; NULL keys are one key.

    Rows are cut into ranges by key and order, so a hot key spans many of them.  A row's number is its
    number in its range plus those of its key in the ranges before, of which only the counts meet.
    """
    columns = df.columns
    ranged = _ranges(df, [*[F.col(k) for k in keys], *order])
    here = Window.partitionBy("__part", *keys).orderBy(*order)
    numbered = ranged.withColumn("__n", F.row_number().over(here))
    # a row for each range and key; only the first key of a range can have rows before, so there is a row a range
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = counts.withColumn("__before", F.sum("__rows").over(earlier)).where("__before > 0")
    before = before.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__part").alias("__p"), "__before")
    same = numbered["__part"] == before["__p"]
    for k in keys:
        same = same & numbered[k].eqNullSafe(before[f"__{k}"])
    total = F.col("__n") + F.coalesce("__before", F.lit(0))
    return numbered.join(F.broadcast(before), same, "left").select(*columns, total.cast("bigint").alias(name))


def order_rank(
    orders: DataFrame, customer: str, ts: str, tie: str, name: str = "customer_order_rank"
) -> DataFrame:
    """1, 2, 3 ... per customer by time, then by ``tie``; NULL times come last.

    Any share of the orders may be one customer's, at one time or without one.
    """
    return running_number(orders, [customer], [F.asc_nulls_last(ts), F.asc(tie)], name)


def first_repeat(rank: Column) -> dict[str, Column]:
    return {"is_first_purchase": rank == 1, "is_repeat_customer": rank > 1}


def first_orders(orders: DataFrame, customer: str, ts: str, tie: str, as_text: bool = False) -> DataFrame:
    """The order each customer placed first: rank 1 without ranking, so it combines map-side.

    With ``as_text`` orders of one time are compared by ``tie`` as a string.
    """
    no_time = F.lit("9999-12-31").cast("timestamp_ntz")
    by = [F.col(tie).cast("string").alias("s")] if as_text else []
    earliest = F.min(F.struct(F.coalesce(F.col(ts), no_time).alias("t"), *by, F.col(tie).alias("k")))
    return orders.groupBy(customer).agg(earliest.alias("e")).select(F.col("e.k").alias(tie))


def dupe_rows(df: DataFrame, columns: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Every row after the first per key, where ``order``, then the other columns, say which row is first.

    Equal rows are counted first, map-side, so a table that is one row many times is one row here; the
    different ones get numbers that no hot key holds up.  A first row counts once less, and
    the counts are laid out again in pieces.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__count"))
    rest = [F.asc(c) for c in df.columns if c not in columns]
    ranked = running_number(counted, columns, [*[F.asc(o) if isinstance(o, str) else o for o in order], *rest], "__rank")
    left = F.col("__count") - F.when(F.col("__rank") == 1, 1).otherwise(0)
    repeats = ranked.withColumn("__left", left).where("__left > 0")
    many = f"__left > {COPIES}"
    few = repeats.where(f"not ({many})").withColumn("__piece", F.lit(0).cast("bigint"))
    # only rows of very many copies are dealt out before they are laid out
    pieces = repeats.where(many).withColumn("__piece", F.explode(F.expr(f"sequence(0L, (__left - 1) div {COPIES})")))
    here = F.least(F.lit(COPIES), F.col("__left") - F.col("__piece") * COPIES).cast("int")
    # a stated number of partitions, as the pieces look small before they are laid out
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = few.unionByName(pieces.repartition(n, "__piece", *columns))
    return dealt.withColumn("__copy", F.explode(F.sequence(F.lit(1), here))).select(*df.columns)


def latest_per(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """The row of the latest period for each key (an aggregate, so no sort per key)."""
    rest = [c for c in df.columns if c not in keys and c != period]
    best = df.groupBy(*keys).agg(F.max(F.struct(period, *rest)).alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns])
