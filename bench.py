"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 3)
BENCH_QUERIES  comma-separated keys, or "all"

Queries that read the stored star pay for loading it in their warm-up; the
load is timed apart as ``load_star``.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tillwork.session import build_session
from tillwork.sources.retail import Retail
from tillwork.suite import QUERIES
from tillwork.suite.star import stored_star

HEADLINE = [
    "build_dim_customer",
    "build_fact_sales",
    "build_fact_orders",
    "build_fact_reviews",
    "surrogate_key",
    "merge_upsert",
    "merge_insert_absent",
    "window_order_rank",
    "dupe_rows_keep_first",
    "join_fanout_many",
    "agg_count_distinct",
    "dq_report",
    "ab_exposure_events",
    "bayes_customer_level_prior",
    "bayes_monthly_chain",
    "bayes_prob_b_beats_a",
    "bayes_credible_interval",
    "report_exec_summary_full",
    "report_segments",
    "report_top_categories",
    "report_top_states",
    "report_all_months",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    keys = list(QUERIES) if chosen == "all" else [k for k in chosen.split(",") if k] or HEADLINE

    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(key: str) -> float:
        start = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds: dict[str, float] = {}
    once("agg_count_distinct")  # start-up of the session is not part of any query
    start = time.perf_counter()
    stored_star(Retail(spark, sf_dir)).read("fact_sales")
    seconds["load_star"] = time.perf_counter() - start
    for key in keys:
        once(key)
        seconds[key] = statistics.median(once(key) for _ in range(runs))

    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
