"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data, BENCH_CPUS (default 8)
the cores, BENCH_RUNS (default 3) the timed runs after one warm-up; the median
counts. Every run builds the query anew and computes all its rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallywatch.queries import QUERIES
from tallywatch.session import build_session

HEADLINE = [
    "flagship",
    "win_behavior",
    "win_rank_type",
    "win_sessions",
    "win_dest_first",
    "stat_zscore",
    "ledger_report",
    "dq_reconcile",
    "fact_transactions",
    "feature_table",
    "scd2_update",
    "upsert_full",
    "upsert_pruned",
    "change_set",
    "agg_daily_fraud",
    "v_cards",
    "v_detail",
]


def seconds(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        spark_master=f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds(spark, QUERIES[name], sf_dir)
        times[name] = round(
            statistics.median(seconds(spark, QUERIES[name], sf_dir) for _ in range(runs)), 3
        )
    total = round(sum(times.values()), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
