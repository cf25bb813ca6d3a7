"""Experiment counts and posteriors over an event stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwork.operators.bayes import posterior, save_posterior
from tillwork.operators.experiment import EVEN_SPLIT, assign_variant
from tillwork.sources.files import publish


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, with a time type that watermarks accept."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # the brackets make the path a pattern, so that it may name a file or a folder
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def daily_counts(
    events: DataFrame, allocations: Mapping[str, float] = EVEN_SPLIT
) -> DataFrame:
    """Exposures (views) and conversions (purchases) per variant and day.

    Works on a stream and on a static table alike.  State is one row per day
    and variant, kept for good: late events still count.
    """
    kinds = events.where(F.col("event_type").isin("view", "purchase"))
    counted = (
        assign_variant(kinds, "user_id", allocations)
        .groupBy(F.window("ts", "1 day").alias("day"), "variant_id")
        .agg(
            F.count_if(F.col("event_type") == "view").alias("exposures"),
            F.count_if(F.col("event_type") == "purchase").alias("conversions"),
        )
    )
    return counted.select(
        F.col("day.start").cast("date").alias("event_day"), "variant_id", "exposures", "conversions"
    )


def stream_ab_counts(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the published table at ``path`` equal to the counts so far.  Starts a query.

    Complete mode hands over the whole small result each time, and a batch is
    published under its number: one replayed after a failure changes nothing,
    and a reader always finds a whole table (``scan_published``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        publish(batch, path, batch_id)

    return (
        daily_counts(stream)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def daily_trials(
    events: DataFrame, period: dt.date, allocations: Mapping[str, float] = EVEN_SPLIT
) -> DataFrame:
    """Users and days of the month of ``period`` with a view or purchase, and whether one bought.

    A user who views or buys on a day is one trial, and a success if there was
    a purchase, so successes never exceed trials.
    """
    first = period.replace(day=1)
    following = (first + dt.timedelta(days=32)).replace(day=1)
    in_month = (F.col("ts") >= F.lit(first).cast("timestamp")) & (F.col("ts") < F.lit(following).cast("timestamp"))
    kinds = events.where(F.col("event_type").isin("view", "purchase") & in_month)
    return (
        assign_variant(kinds, "user_id", allocations)
        .groupBy("user_id", F.window("ts", "1 day").alias("day"), "variant_id")
        .agg(F.max(F.col("event_type") == "purchase").alias("bought"))
    )


def stream_posteriors(
    stream: DataFrame,
    store: DataFrame,
    test_id: str,
    period_date: dt.date,
    path: str,
    checkpoint: str,
    run_ts: dt.datetime,
) -> StreamingQuery:
    """Keep the published store at ``path`` equal to ``store`` with the stream's posterior merged in.

    Each batch starts again from the stored prior and the totals of the
    period's month, so nothing is counted twice however often a batch runs.
    State is one row per user and day of that month.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        totals = batch.groupBy("variant_id").agg(
            F.count(F.lit(1)).alias("data_points"), F.count_if("bought").alias("conversions")
        )
        counts = totals.select(
            F.lit(test_id).alias("test_id"),
            "variant_id",
            F.lit(period_date).alias("period_date"),
            "data_points",
            "conversions",
        )
        prior = store.where(
            (F.col("value_type") == "prior")
            & (F.col("period_date") == F.lit(period_date))
            & (F.col("test_id") == test_id)
        )
        merged = save_posterior(store, posterior(prior, counts), run_ts, notes="Streaming posterior update")
        publish(merged, path, batch_id)

    return (
        daily_trials(stream, period_date)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
