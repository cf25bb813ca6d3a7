"""Facts stored by month, changed by whole versions of the months that a batch touches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.operators.merge import merge_upsert, row_key
from tillwork.sources.files import delete, keep, publish, scan_published, sink_overwrite, versions

MONTH = "date_month"
#: pointers that are kept, with the data they name, for readers still at work
KEEP = 2


class MonthlyTable:
    """A table below ``path``, partitioned by month of ``date_key`` (yyyymmdd; NULL is a month of its own).

    Data lies in ``data/version=N/date_month=M``; the newest whole pointer below ``months`` says
    which version of each month counts.  A load writes the months that it touches as a new version, and
    only then the pointer: one that breaks off in between leaves the old table, and is overwritten when
    it is run again.  One writer at a time, any number of readers.
    """

    def __init__(self, spark: SparkSession, path: str, date_key: str):
        self.spark, self.path, self.date_key = spark, path.rstrip("/"), date_key
        self._pointers: dict[int, list] = {}

    def _pointer(self) -> tuple[int, list]:
        """(number, rows of month, version, n, top) of the newest pointer; a row a month."""
        known = versions(self.spark, f"{self.path}/months")
        if not known:
            return 0, []
        number, folder = known[-1]
        if number not in self._pointers:
            self._pointers = {number: self.spark.read.parquet(folder).collect()}
        return number, self._pointers[number]

    def exists(self) -> bool:
        return bool(versions(self.spark, f"{self.path}/months"))

    def read(self) -> DataFrame:
        number, rows = self._pointer()
        if number == 0:
            raise FileNotFoundError(f"no whole version of {self.path}")
        data = f"{self.path}/data"
        part = {None: "__HIVE_DEFAULT_PARTITION__"}
        folders = [f"{data}/version={r.version}/{MONTH}={part.get(r.month, r.month)}" for r in rows]
        if not folders:
            return scan_published(self.spark, f"{self.path}/empty")
        return self.spark.read.option("basePath", data).parquet(*folders).drop("version")

    def versions_by_month(self) -> dict[int | None, int]:
        """Which version of each month counts now."""
        return {r.month: r.version for r in self._pointer()[1]}

    def months(self, months: Sequence[int | None]) -> DataFrame:
        """The rows of some months, by a partition filter."""
        some = F.col(MONTH).isin([m for m in months if m is not None])
        return self.read().where(some | F.col(MONTH).isNull() if None in months else some)

    def _with_month(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(MONTH, (F.col(self.date_key) / 100).cast("int"))

    def _numbered(self, stored: DataFrame, name: str, top: int) -> DataFrame:
        """The rows of a stored table, or of some of its months, with the numbers after ``top`` as ``name``."""
        rows = row_key(stored.drop(name), name, fixed=True).withColumn(name, F.col(name) + top)
        return rows.select(stored.columns) if name in stored.columns else rows

    def _store(self, rows: DataFrame, others: list, name: str | None) -> None:
        """Write ``rows`` as the next version and point to it for their months, and to ``others`` for theirs."""
        number = self._pointer()[0] + 1
        folder = f"{self.path}/data/version={number}"
        sink_overwrite(rows, folder, [MONTH])
        top = F.max(name) if name else F.lit(None)
        back = self.spark.read.schema(rows.schema).parquet(folder)
        sums = back.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n"), top.cast("bigint").alias("top"))
        written = [(r[MONTH], number, r.n, r.top) for r in sums.collect()]
        if not written and not others:
            publish(rows.limit(0), f"{self.path}/empty", number)
        pointer = [*written, *[tuple(r) for r in others]]
        publish(self.spark.createDataFrame(pointer, "month int, version int, n long, top long"), f"{self.path}/months", number, keep=KEEP)
        self._drop_unused()

    def _drop_unused(self) -> None:
        pointers = [folder for _, folder in versions(self.spark, f"{self.path}/months")]
        used = {r.version for r in self.spark.read.parquet(*pointers).select("version").distinct().collect()}
        for number, folder in versions(self.spark, f"{self.path}/data", "version="):
            if number not in used:
                delete(self.spark, folder)

    def replace(self, rows: DataFrame, name: str | None = None, fixed: bool = False) -> DataFrame:
        """Store ``rows`` in the place of all there is; ``name`` is a key to number them by, from 1.

        ``fixed``: see ``merge``.
        """
        if name:
            rows = self._numbered(rows if fixed else keep(rows, "load"), name, 0)
        self._store(self._with_month(rows), [], name)
        return self.read()

    def merge(
        self,
        rows: DataFrame,
        keys: Sequence[str],
        name: str | None = None,
        updates: Sequence[str] = (),
        everywhere: bool = False,
        fixed: bool = False,
    ) -> DataFrame:
        """Add the rows whose key the table lacks; with ``updates`` refresh those columns of the others.

        ``rows`` is evaluated once, or, where ``fixed`` says that they are rows of a stored table, picked one by one, not
        stored again.  Only the months that it has rows in are read and written, so a key has
        to keep its month, and rows of a month that the table lacks are new without a look; with ``everywhere`` the keys of all months are compared, for rows
        that are dated by when they were made.  All rows of a new key come in; ``updates`` needs keys that
        are unique in ``rows``.  New rows get the numbers after the largest under ``name``.
        """
        if not self.exists():
            return self.replace(rows, name, fixed)
        staged = self._with_month(rows) if fixed else keep(self._with_month(rows), "load")
        touched = [r[0] for r in staged.select(MONTH).distinct().collect()]
        if not touched:
            return self.read()
        _, pointer = self._pointer()
        old = self.months(touched)
        stored = {r.month for r in pointer}
        if everywhere or stored.issuperset(touched):
            seen, compared, parts = self.read() if everywhere else old, staged, []
        else:
            both = F.coalesce(F.col(MONTH).isin([m for m in touched if m in stored and m is not None]), F.lit(None in stored))
            seen, compared, parts = old, staged.where(both), [staged.where(~both)]
        if not parts and compared.select(*keys).join(seen.select(*keys), list(keys), "left_semi").isEmpty():
            # by the bare keys all rows are new: they need not move to be picked
            parts.append(compared)
        elif not parts or not stored.isdisjoint(touched):
            # first, as the rows of all parts but the last are counted
            parts.insert(0, keep(compared.join(seen.select(*keys), list(keys), "left_anti"), "load"))
        if name:
            top = max((r.top or 0 for r in pointer), default=0)
            for i, part in enumerate(parts):
                parts[i] = self._numbered(part, name, top)
                top += part.count() if i + 1 < len(parts) else 0
        fresh = reduce(DataFrame.unionByName, parts)
        if updates:
            known = compared.join(old.select(*keys), list(keys), "left_semi")
            old = merge_upsert(old, known, keys, updates)
        merged = old.unionByName(fresh.select(*old.columns))
        self._store(merged, [r for r in pointer if r.month not in touched], name)
        return self.read()
