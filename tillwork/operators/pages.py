"""Exact distinct counts that add up: stored bitmaps of integer keys.

A page holds which of 32,768 neighbouring keys occur, in 4 KB.  Pages of parts are merged bit by bit, so
the distinct count of any union of parts comes from stored pages alone, without its rows.  Dense keys, as
key maps give them, fill their pages; a group with very many keys has many pages and spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_pages(rows: DataFrame, key: str, *by: str) -> DataFrame:
    """(by, page, bits): the integer keys of each group; NULL keys are not counted."""
    number = F.col(key).cast("bigint")
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(*by, F.bitmap_bucket_number(number).alias("page"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )


def merged_pages(pages: DataFrame, *by: str) -> DataFrame:
    """The pages of coarser groups."""
    return pages.groupBy(*by, "page").agg(F.bitmap_or_agg(F.col("bits")).alias("bits"))


def distinct_counts(pages: DataFrame, name: str, *by: str) -> DataFrame:
    """(by, name): the distinct keys of each group; of all pages, one row, without ``by``."""
    counted = F.coalesce(F.sum(F.bitmap_count(F.col("bits"))), F.lit(0))
    return merged_pages(pages, *by).groupBy(*by).agg(counted.alias(name))
