"""Small pieces that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.session import work_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: a word is a run of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``key``, checked by ``sql`` where SQL can say it."""

    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a work table to the shared folder and read it back.

    Cuts the lineage like ``checkpoint()``: a lost executor loses nothing of it.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """The number of words; null counts as empty.

    Each word shrinks to one letter, so no array of words is built.
    """
    letters = F.regexp_replace(text, r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++", "w")
    return F.coalesce(F.length(F.regexp_replace(letters, r"[^w]+", "")), F.lit(0)).cast("long")
