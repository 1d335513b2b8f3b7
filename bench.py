"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default the given sf0.1 tables), ``BENCH_CPUS`` (default 8). Each query
runs twice to completion, without collecting; the faster run counts, plan building
included. ``fact_rows_per_sec`` relates the settlement plans to their fact table, and
``yardstick_sec`` is a fixed job that tells machines apart: it reads no table and is not
part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from sparkretail.plans import registry  # noqa: E402
from sparkretail.session import get_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = 2
SETTLEMENT = (
    "price_auto", "price_broadcast", "price_period_key", "price_isolate", "price_salted",
    "price_pruned", "price_aqe", "price_naive", "settle_by_entry", "settle_by_entry_salted",
)
OTHERS = (
    "line_revenue", "clean_sales", "collapse_tickets", "store_list", "store_contribution",
    "store_payment_profile", "store_rollup", "store_segments", "orphan_sales",
    "customer_totals", "latest_order_per_customer", "enriched_clicks", "interval_pairs",
    "dataset_diff", "sorted_export", "tree_difference", "customer_running_totals", "ranked_export",
    "colocated_orders", "rewritten_month",
)


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def yardstick(spark) -> float:
    """Seconds for hashing and grouping 20 million numbers, the faster of two runs."""
    job = spark.range(0, 20_000_000, 1, CPUS).selectExpr("id % 1000 AS k", "xxhash64(id) % 1000003 AS v")
    return min(timed(lambda: job.groupBy("k").sum("v").collect()) for _ in range(RUNS))


def main() -> None:
    spark = get_session(
        "bench",
        master=f"local[{CPUS}]",
        conf={
            "spark.sql.shuffle.partitions": str(CPUS),
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    fixed = yardstick(spark)
    seconds = {}
    for name in SETTLEMENT + OTHERS:
        run = queries[name]
        seconds[name] = round(
            min(timed(lambda: run(spark, SF_DIR).write.format("noop").mode("overwrite").save()) for _ in range(RUNS)), 3
        )
    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "yardstick_sec": round(fixed, 3),
                "fact_rows": rows,
                "fact_rows_per_sec": {n: round(rows / seconds[n]) for n in SETTLEMENT},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
