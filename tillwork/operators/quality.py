"""Data-quality checks.  Each returns rows of (check_name, severity, violations, passed).

Checks on columns of one table are aggregates, so any number of them share one
pass (``run_rules``).  Key checks group by the key and reference checks count
per reference before they join, so neither moves whole rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork import catalog
from tillwork.operators.aggregates import dupe_values
from tillwork.operators.relational import any_null, bad_dates

WARN, FAIL = "warn", "fail"
REPORT_COLUMNS = ("check_name", "severity", "violations", "passed")


class QualityError(Exception):
    """A check of severity ``fail`` found violations."""


@dataclass(frozen=True)
class Rule:
    """One check: ``violations`` is an aggregate over the rows of a table."""

    name: str
    severity: str
    violations: Column


def run_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rules on one table in a single pass."""
    counts = df.agg(
        *[F.coalesce(r.violations, F.lit(0)).cast("bigint").alias(f"v{i}") for i, r in enumerate(rules)]
    )
    rows = [
        F.struct(
            F.lit(r.name).alias("check_name"),
            F.lit(r.severity).alias("severity"),
            F.col(f"v{i}").alias("violations"),
            (F.col(f"v{i}") == 0).alias("passed"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


# -- rules on one table -------------------------------------------------------


def nulls_rule(name: str, columns: Sequence[str]) -> Rule:
    return Rule(name, WARN, F.count_if(any_null(columns)))


def not_null_rules(table: str, columns: Sequence[str]) -> list[Rule]:
    return [Rule(f"not_null:{table}.{c}", FAIL, F.count_if(F.col(c).isNull())) for c in columns]


def dates_rule(name: str, start: str, end: str, floor: dt.date, as_of: dt.date) -> Rule:
    return Rule(name, WARN, F.count_if(bad_dates(start, end, floor, as_of)))


def freshness_rule(name: str, ts: str, as_of: dt.date, max_days: int) -> Rule:
    age = F.datediff(F.lit(as_of), F.max(ts))
    return Rule(name, WARN, F.when(age <= max_days, 0).otherwise(1))


def nonempty_rule(name: str) -> Rule:
    return Rule(name, FAIL, F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))


# -- checks -------------------------------------------------------------------


def check_nulls(df: DataFrame, columns: Sequence[str], name: str = "nulls") -> DataFrame:
    return run_rules(df, [nulls_rule(name, columns)])


def check_not_null(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    return run_rules(df, not_null_rules(table, columns))


def check_dates(
    df: DataFrame, start: str, end: str, floor: dt.date, as_of: dt.date, name: str = "date_ranges"
) -> DataFrame:
    return run_rules(df, [dates_rule(name, start, end, floor, as_of)])


def check_freshness(
    df: DataFrame, ts: str, as_of: dt.date, max_days: int, name: str = "freshness"
) -> DataFrame:
    return run_rules(df, [freshness_rule(name, ts, as_of, max_days)])


def check_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Key values that occur more than once; NULL keys never collide."""
    repeated = dupe_values(df.dropna(subset=list(keys)), keys)
    return run_rules(repeated, [Rule(name, FAIL, F.count(F.lit(1)))])


def check_fk(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str, nulls_allowed: bool = False
) -> DataFrame:
    """Child rows whose reference has no parent.

    Without ``nulls_allowed`` a NULL reference counts as an orphan.  The child
    is counted per reference first: a reference shared by very many rows is
    one row in the join.
    """
    per_reference = child.groupBy(F.col(fk).alias("ref")).agg(F.count(F.lit(1)).alias("n"))
    if nulls_allowed:
        per_reference = per_reference.where(F.col("ref").isNotNull())
    lost = per_reference.join(parent.select(F.col(pk).alias("ref")), "ref", "left_anti")
    return run_rules(lost, [Rule(name, FAIL, F.sum("n"))])


def check_events(events: DataFrame, name: str = "events_nonempty") -> DataFrame:
    """Fails on an empty event table; also reports events and distinct customers."""
    per_customer = events.groupBy("customer_key").agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_customer.agg(
        total.alias("total_events"), F.count("customer_key").alias("unique_customers")
    ).select(
        F.lit(name).alias("check_name"),
        F.lit(FAIL).alias("severity"),
        F.when(F.col("total_events") == 0, 1).otherwise(0).cast("bigint").alias("violations"),
        (F.col("total_events") > 0).alias("passed"),
        "total_events",
        "unique_customers",
    )


# -- reports ------------------------------------------------------------------


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [p.select(*REPORT_COLUMNS) for p in parts])


def quality_report(
    tables: Mapping[str, DataFrame],
    as_of: dt.date,
    floor: dt.date = dt.date(2016, 1, 1),
    max_days: int = 31,
) -> DataFrame:
    """The standing checks on customers, orders and experiment events."""
    customers, orders, events = tables["customers"], tables["orders"], tables["events"]
    bought, arrived = "order_purchase_timestamp", "order_delivered_customer_date"
    return _union(
        [
            run_rules(
                customers,
                [
                    nulls_rule("nulls:customers", ["customer_id", "customer_unique_id"]),
                    *not_null_rules("customers", ["customer_id"]),
                ],
            ),
            run_rules(
                orders,
                [
                    dates_rule("dates:orders", bought, arrived, floor, as_of),
                    freshness_rule("freshness:orders", bought, as_of, max_days),
                    *not_null_rules("orders", ["order_id"]),
                ],
            ),
            check_unique(customers, ["customer_id"], "unique:customers"),
            check_unique(orders, ["order_id"], "unique:orders"),
            check_fk(orders, "customer_id", customers, "customer_id", "fk:orders.customer_id"),
            check_events(events, "nonempty:events"),
        ]
    )


def star_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Declared constraints of every star table given: required columns, keys, references.

    Each table is read once, however many constraints it has: a row becomes a (check, value) for each
    key, each reference, each time it is referred to and each required column that it lacks.  These are
    counted in one aggregation, which combines map-side, so a value that very many rows share is a row
    a task; the counts settle all checks.
    """
    names: list[str] = []
    parts: dict[str, list[Column]] = {name: [] for name in tables}
    unique, references = [], []

    def add(name: str) -> int:
        names.append(name)
        return len(names) - 1

    def item(check: int, value: Column, child: int, parent: int, when: Column) -> Column:
        fields = {"check": F.lit(check), "value": value.cast("string"), "child": F.lit(child), "parent": F.lit(parent)}
        return F.when(when, F.struct(*[c.alias(n) for n, c in fields.items()]))

    for table in tables:
        for c in catalog.required_columns(table):
            parts[table].append(item(add(f"not_null:{table}.{c}"), F.lit(None), 1, 0, F.col(c).isNull()))
        for keys in catalog.UNIQUE_KEYS.get(table, []):
            unique.append(add(f"unique:{table}({','.join(keys)})"))
            value = F.to_json(F.array(*[F.col(k).cast("string") for k in keys])) if len(keys) > 1 else F.col(keys[0])
            parts[table].append(item(unique[-1], value, 1, 0, ~any_null(keys)))
    for child, fk, parent, pk in catalog.FOREIGN_KEYS:
        if child in tables and parent in tables:
            references.append(add(f"fk:{child}.{fk}"))
            parts[child].append(item(references[-1], F.col(fk), 1, 0, F.col(fk).isNotNull()))
            parts[parent].append(item(references[-1], F.col(pk), 0, 1, F.col(pk).isNotNull()))

    rows = [tables[t].select(F.inline(F.array_compact(F.array(*p)))) for t, p in parts.items() if p]
    counted = reduce(DataFrame.unionByName, rows).groupBy("check", "value").agg(
        F.sum("child").alias("child"), F.sum("parent").alias("parent")
    )
    is_unique, is_reference = F.col("check").isin(unique), F.col("check").isin(references)
    found = (
        F.when(is_unique, (F.col("child") > 1).cast("bigint"))
        .when(is_reference, F.when(F.col("parent") == 0, F.col("child")).otherwise(0))
        .otherwise(F.col("child"))
    )
    sums = counted.groupBy("check").agg(F.sum(found).alias("v"))
    listed = sums.sparkSession.createDataFrame(list(enumerate(names)), "check int, check_name string")
    violations = F.coalesce("v", F.lit(0)).cast("bigint")
    return listed.join(sums, "check", "left").select(
        "check_name", F.lit(FAIL).alias("severity"), violations.alias("violations"), (violations == 0).alias("passed")
    )


def enforce(report: DataFrame) -> list[tuple[str, int]]:
    """Raise when a ``fail`` check has violations, else return the warnings.

    Runs the report.  It has one row per check, so collecting it is bounded.
    """
    rows = report.where(~F.col("passed")).collect()
    failed = [(r.check_name, r.violations) for r in rows if r.severity == FAIL]
    if failed:
        raise QualityError("; ".join(f"{name}: {n}" for name, n in sorted(failed)))
    return sorted((r.check_name, r.violations) for r in rows)
