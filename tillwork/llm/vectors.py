"""What the vector searches share: usable vectors as binary columns, and batches of them in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor holding null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def one_per_id(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as array<double>): the usable vectors; of several for an id the least."""
    good = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    return good.groupBy("vec_id").agg(F.min(F.col("embedding").cast("array<double>")).alias("embedding"))


def matrix(rows: list, width: int | None = None, dtype=np.float64) -> np.ndarray:
    """Lists as the rows of a matrix; shorter ones are filled up with zeros."""
    width = max([width or 0, *map(len, rows)])
    out = np.zeros((len(rows), width), dtype)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def top_rows(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids."""
    if len(score) > 4 * k:
        # all that tie with the k-th stay for the sort
        kth = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= kth)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], -score[some]))[:k]]
