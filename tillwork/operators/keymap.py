"""Stored maps from natural keys to generated ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.operators.merge import bare_keys, surrogate_key
from tillwork.sources.files import keep, publish, versions

#: keys that are numbered in one task, about
BUCKET_ROWS = 1 << 20


class KeyMap:
    """An append-only table below ``path``: the columns ``natural`` and their key ``name``.

    Each extension is a numbered batch of the keys that were new then; a batch that is not whole does not
    count and is written again.  A key once stored never changes, whatever is loaded later or again.
    One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, natural: str | Sequence[str], name: str):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self.natural = [natural] if isinstance(natural, str) else list(natural)

    def read(self) -> DataFrame | None:
        """All keys so far, None before the first."""
        whole = [folder for _, folder in versions(self.spark, self.path)]
        return self.spark.read.parquet(*whole) if whole else None

    def extend(self, rows: DataFrame) -> DataFrame:
        """The map, with the keys of ``rows`` that it lacked numbered from one above the largest.

        Of ``rows`` only the bare key is read, once; rows with a NULL in it have no key.
        """
        known = self.read()
        lacking = bare_keys(rows, self.natural)
        if known is not None:
            lacking = lacking.join(known.select(*self.natural), self.natural, "left_anti")
        lacking = keep(lacking, f"keys-{self.name}")
        n = lacking.count()
        if n == 0 and known is not None:
            return known
        buckets = max(4096, 1 << (n // BUCKET_ROWS).bit_length())
        numbered = surrogate_key(lacking, self.natural, self.name, buckets)
        if known is not None:
            top = known.agg(F.max(self.name)).first()[0] or 0
            numbered = numbered.withColumn(self.name, F.col(self.name) + top)
        batches = versions(self.spark, self.path)
        publish(numbered, self.path, batches[-1][0] + 1 if batches else 1, keep=None)
        return self.read()
