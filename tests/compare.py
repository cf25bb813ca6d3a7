"""Compare a Spark result with DuckDB's answer to the SQL check: names, types, rows."""

from __future__ import annotations

import collections
import datetime as dt
import math

import duckdb
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    T.LongType: {"BIGINT"},
    T.IntegerType: {"INTEGER"},
    T.DoubleType: {"DOUBLE"},
    T.StringType: {"VARCHAR"},
    T.DateType: {"DATE"},
    T.BooleanType: {"BOOLEAN"},
    T.TimestampNTZType: {"TIMESTAMP"},
    T.TimestampType: {"TIMESTAMP", "TIMESTAMP WITH TIME ZONE"},
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def compare(df, con, sql: str, tolerance: float = 0.0) -> list[str]:
    """Differences, empty when the results agree."""
    res = con.execute(sql)
    duck_cols = {d[0]: str(d[1]) for d in res.description}
    problems = []
    if set(duck_cols) != set(df.columns):
        return [f"columns: spark {sorted(df.columns)} duckdb {sorted(duck_cols)}"]
    for f in df.schema.fields:
        if duck_cols[f.name] not in SPARK_TO_DUCK.get(type(f.dataType), set()):
            problems.append(f"type of {f.name}: spark {f.dataType.simpleString()} duckdb {duck_cols[f.name]}")
    names = sorted(df.columns)
    order = [list(duck_cols).index(n) for n in names]
    theirs = [tuple(norm(row[i]) for i in order) for row in res.fetchall()]
    ours = [tuple(norm(row[n]) for n in names) for row in df.collect()]
    if len(ours) != len(theirs):
        problems.append(f"rows: spark {len(ours)} duckdb {len(theirs)}")
    a, b = collections.Counter(ours), collections.Counter(theirs)
    if a != b:
        only_a, only_b = list((a - b).elements()), list((b - a).elements())
        problems.append(f"{len(only_a)} rows differ {names}: spark {only_a[:3]} duckdb {only_b[:3]}")
    if not theirs:
        problems.append("empty result")
    return problems
