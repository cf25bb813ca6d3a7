"""Query registration and the shared pieces of Spark setup."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.sources.retail import Retail

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare across engines."""
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
            for f in df.schema.fields
        ]
    )


def query(key: str, sql: str | None = None):
    """Register ``fn(retail)`` under ``key``, checked by ``sql``."""

    def register(fn: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(Retail(spark, sf_dir)))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
