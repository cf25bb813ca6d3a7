"""Scans, sinks, literal tables and table creation."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.session import work_path

#: of work tables and facts, which are written and read far more often than anyone looks at them
CODEC = "zstd"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV into a typed table.  The schema is given, so there is no inference pass.

    Quoted fields may hold line breaks; quotes inside them are doubled.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", _has_free_text(schema))
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def _has_free_text(schema: T.StructType) -> bool:
    # only review text holds line breaks; other files stay splittable
    return any(f.name in ("review_comment_message", "review_comment_title") for f in schema.fields)


def sink_csv(df: DataFrame, path: str) -> str:
    """Write with a header and without an index column.  Runs a job."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def sink_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Replace the whole table at ``path``.  Runs a job.

    With ``partition_by`` the rows are rebalanced by those columns first: one
    file per partition value where it is small, several where it is hot.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: it is evaluated once, and its plan ends here."""
    path = work_path(df.sparkSession, label)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def versions(spark: SparkSession, path: str, prefix: str = "v=") -> list[tuple[int, str]]:
    """Numbers and folders of the whole versions below ``path``, oldest first."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    folders = [s.getPath() for s in fs.listStatus(root)]
    whole = [f for f in folders if f.getName().startswith(prefix) and fs.exists(jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted((int(f.getName().removeprefix(prefix)), f.toString()) for f in whole)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def publish(df: DataFrame, path: str, version: int, keep: int | None = 2) -> str:
    """Write ``df`` as a version of the table at ``path``; a version that is whole stays as it is.

    Readers take the newest whole version, so they never see a part of one.
    The ``keep`` newest stay for readers that are still at work, all if None.
    """
    spark = df.sparkSession
    if version in dict(versions(spark, path)):
        # a stream's batch has to run for its state to be kept
        df.write.format("noop").mode("overwrite").save()
    else:
        sink_overwrite(df, f"{path}/v={version}")
    for _, old in versions(spark, path)[:-keep] if keep else []:
        delete(spark, old)
    return path


def scan_published(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of a published table."""
    whole = versions(spark, path)
    if not whole:
        raise FileNotFoundError(f"no whole version of {path}")
    return spark.read.parquet(whole[-1][1])


def scan_sql(spark: SparkSession, query: str, args: dict[str, Any], **tables: DataFrame) -> DataFrame:
    """SQL with named parameters (``:name``) over DataFrames passed by keyword (``{table}``)."""
    return spark.sql(query, args=args, **tables)


def values_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Literal rows as a table."""
    return spark.createDataFrame(list(rows), schema)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table with the fixed columns and no rows, for a target that does not exist yet."""
    return spark.createDataFrame([], schema)


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows in a stated order (a top-n, not a sort of the table)."""
    return df.orderBy(*order_by).limit(n)
