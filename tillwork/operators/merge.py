"""Merges, appends, defaults and generated keys."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.functions.scalars import hash_bucket
from tillwork.session import shared_folder


def ctas_temp(df: DataFrame, name: str) -> DataFrame:
    """Register a query under a session name and read it back through that name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Fill NULLs of the named columns, adding a column where it is missing.

    Run times are among the values, given by the caller rather than the clock.
    """
    have = set(df.columns)
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value)) if name in have else F.lit(value)
            for name, value in defaults.items()
        }
    )


def insert_select(
    target: DataFrame, source: DataFrame, columns: Sequence[str], defaults: Mapping[str, Any] | None = None
) -> DataFrame:
    """Append the named columns of ``source``; the others take a default or NULL."""
    defaults = dict(defaults or {})
    named = set(columns)
    aligned = source.select(
        [
            (F.col(f.name) if f.name in named else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )
    return target.unionByName(aligned)


def _has_key(keys: Sequence[str]) -> Column:
    """No part of the key is NULL; NULLs conflict with nothing, as in a unique constraint."""
    has = F.lit(True)
    for k in keys:
        has = has & F.col(k).isNotNull()
    return has


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    """The same rows; the query fails when a key occurs twice.

    Row numbers need the shuffle and sort by key that a merge join needs too,
    so this adds neither.  Rows with a NULL in the key pass by, told apart by
    their other columns so that they are no group.
    """
    rest = [f.name for f in df.schema.fields if f.name not in keys and not isinstance(f.dataType, T.MapType)]
    nullable = rest and any(df.schema[k].nullable for k in keys)
    apart = [F.when(~_has_key(keys), F.xxhash64(*rest))] if nullable else []
    nth = F.row_number().over(Window.partitionBy(*keys, *apart).orderBy(*keys))
    message = F.lit(f"{what} has more than one row for a key of ({', '.join(keys)})")
    fits = (F.col("__nth") == 1) | ~_has_key(keys)
    ok = F.when(fits, True).otherwise(F.raise_error(message).cast("boolean"))
    return df.withColumn("__nth", nth).where(ok).drop("__nth")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    touch_col: str | None = None,
    run_ts: dt.datetime | None = None,
    insert_defaults: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Insert new keys; for known keys overwrite ``update_cols`` only.

    ``touch_col`` gets ``run_ts``, which it demands, on every row the source
    touches.  Columns outside ``update_cols`` keep the target's value.  Keys
    must be unique in the source; a repeat fails the query.  Rows with a NULL
    in the key match nothing: the target's stay, the source's are inserted.
    """
    insert_defaults = dict(insert_defaults or {})
    unknown = set(update_cols) - set(source.columns)
    if unknown:
        raise ValueError(f"source lacks columns to update: {sorted(unknown)}")
    if touch_col is not None and run_ts is None:
        raise ValueError(f"{touch_col} needs a run time")

    def inserted(c: str, old: Column, new: Callable[[str], Column]) -> Column:
        """The value of a column that an update leaves alone, in a new row."""
        if c in source.columns:
            return new(c)
        return F.lit(insert_defaults[c]) if c in insert_defaults else old

    # rows without a key take no part in the join, where they would all meet in one task
    unmatched = source.where(~_has_key(keys)).select(
        [
            (F.lit(run_ts) if f.name == touch_col else inserted(f.name, F.lit(None), F.col)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )
    old = target.where(_has_key(keys)).withColumn("__old", F.lit(True)).alias("t")
    new = require_unique(source.where(_has_key(keys)), keys).withColumn("__new", F.lit(True)).alias("s")
    match = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    both = old.join(new, match, "full")

    known, touched = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    out = []
    for field in target.schema.fields:
        c = field.name
        before = F.col(f"t.{c}")
        if c in keys:
            value = F.coalesce(before, F.col(f"s.{c}"))
        elif c == touch_col:
            value = F.when(touched, F.lit(run_ts)).otherwise(before)
        elif c in update_cols:
            value = F.when(touched, F.col(f"s.{c}")).otherwise(before)
        else:
            value = F.when(known, before).otherwise(inserted(c, before, lambda n: F.col(f"s.{n}")))
        out.append(value.cast(field.dataType).alias(c))
    return both.select(*out).unionByName(target.where(~_has_key(keys))).unionByName(unmatched)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by the remaining columns (combines map-side).

    Rows with a NULL in the key all stay: NULLs are not equal to each other.
    """
    rest = [c for c in df.columns if c not in keys]
    keyed = df.where(_has_key(keys))
    if rest:
        least = keyed.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
        keyed = least.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])
    else:
        keyed = keyed.distinct()
    return keyed.unionByName(df.where(~_has_key(keys)))


def merge_insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert rows whose key is new; repeats within the batch count once."""
    batch = one_per_key(source, keys)
    absent = batch.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(absent, allowMissingColumns=True).select(*target.columns)


def append_rows(target: DataFrame, source: DataFrame, dedupe_keys: Sequence[str] | None = None) -> DataFrame:
    """Append.  Loading a batch twice doubles it unless ``dedupe_keys`` are given."""
    if dedupe_keys:
        return merge_insert_absent(target, source, dedupe_keys)
    return target.unionByName(source, allowMissingColumns=True).select(*target.columns)


def surrogate_key(
    df: DataFrame, natural_key: str | Sequence[str], name: str, buckets: int = 4096
) -> DataFrame:
    """Dense unique integers 1..n, one per natural key, computed in parallel.

    Rows are numbered within hash buckets of the natural key; a running sum of
    the bucket sizes gives each bucket its first number.  Nothing is sampled
    or collected, so a lost executor recomputes the same keys.  The natural
    key has to be unique.

    When ``df`` already has ``name``, only its NULLs are numbered, from one
    above the largest: the way to extend a stored dimension.
    """
    keys = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    fresh = name not in df.columns
    parts = [F.col(k).cast("string") for k in keys]
    text = parts[0] if len(parts) == 1 else F.concat_ws("\x1f", *parts)
    lacks = F.lit(True) if fresh else F.col(name).isNull()
    # never NULL, so the join below adds no null filter that would hash every key again
    bucket = F.coalesce(hash_bucket(text, buckets), F.lit(0))
    numbered = df.withColumn("__bucket", bucket)

    # at most ``buckets`` rows from here on, hence the plain window and the broadcast
    running = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.where(lacks).groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select("__bucket", F.coalesce(F.sum("__n").over(running), F.lit(0)).alias("__start"))

    if fresh:
        local = Window.partitionBy("__bucket").orderBy(*keys)
        rows = numbered.withColumn("__rn", F.row_number().over(local))
        keyed = rows.join(F.broadcast(starts), "__bucket")
        return keyed.select((F.col("__start") + F.col("__rn")).alias(name), *df.columns)

    known = numbered.where(~lacks).select(*df.columns)
    top = F.coalesce(df.agg(F.max(name)).scalar(), F.lit(0))
    local = Window.partitionBy("__bucket").orderBy(*keys)
    rows = numbered.where(lacks).withColumn("__rn", F.row_number().over(local))
    keyed = rows.join(F.broadcast(starts), "__bucket").withColumn(
        name, (F.col("__start") + F.col("__rn") + top).cast("bigint")
    )
    return known.unionByName(keyed.select(*df.columns))


def bare_keys(rows: DataFrame, natural: Sequence[str]) -> DataFrame:
    """The different keys of ``rows``, without those that hold a NULL; nothing else of ``rows`` is read."""
    return rows.where(_has_key(natural)).select(*natural).distinct()


def lacking_keys(rows: DataFrame, target: DataFrame, natural: Sequence[str], name: str) -> DataFrame:
    """(natural, name): a key for each natural key of ``rows`` that ``target`` lacks, from above its largest."""
    lacking = bare_keys(rows, natural).join(target.select(*natural), list(natural), "left_anti")
    top = F.coalesce(target.agg(F.max(name)).scalar(), F.lit(0))
    return surrogate_key(lacking, natural, name).withColumn(name, (F.col(name) + top).cast("bigint"))


def row_key(df: DataFrame, name: str, fixed: bool = False) -> DataFrame:
    """Dense unique integers for rows that have no natural key (identical rows included).

    The rows are checkpointed to the shared folder first, which fixes what
    each partition holds; then a row's number is its place in the partition
    plus the sizes of the partitions before.  No shuffle, and no group to be hot.
    With ``fixed``, ``df`` is the scan of a stored table, which holds still without a checkpoint.
    """
    if not fixed:
        shared_folder(df.sparkSession)
        df = df.checkpoint()
    placed = df.select(
        "*",
        F.spark_partition_id().alias("__part"),
        # the low 33 bits count the rows of one partition
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"),
    )
    # one row per partition
    running = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(F.spark_partition_id().alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(running), F.lit(0)).alias("__start"))
    return placed.join(F.broadcast(starts), "__part").select(
        (F.col("__start") + F.col("__at") + 1).alias(name), *df.columns
    )
