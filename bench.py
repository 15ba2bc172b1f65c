"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (warm runs per query, default 3), BENCH_QUERIES (comma list, optional).
Each query runs once cold, then BENCH_RUNS times; its figure is the median of
the warm runs.  Results go to Spark's `noop` sink, so the whole plan executes
without collecting rows to the driver.  `value` is the sum of the medians of the
the same way and reported under `extra` (BENCH_EXTRA=0 skips them).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "enrich_orders",            # lineitem ⋈ orders, left join catalog, margin
    "revenue_daily",            # + order fact, group by day × category × channel, distinct orders
    "top_products",             # leaderboard
    "inventory_latest",         # latest state per product × store + risk
    "stream_silver_clickstream",  # file bus → stream → watermark + dedupe → parquet sink
]
# Also timed and reported under "extra" (not in `value`).
EXTRA = [
    "silver_clickstream",       # parse, quality flags, valid split
    "dedupe_orders",            # batch dedupe on the contract key
    "strict_type_errors",       # strict JSON kind checks
    "publish_gate",             # strict checks, whole events as sorted-key JSON
    "stock_ledger",             # running floored balance, skew-safe buckets
    "revenue_trend",            # dashboard rollup
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    extra = [] if os.environ.get("BENCH_QUERIES") else [n for n in EXTRA if os.environ.get("BENCH_EXTRA", "1") == "1"]

    from lakecart.plans.registry import QUERIES
    from lakecart.session import build_session

    spark = build_session(app="lakecart-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                          conf={"spark.driver.memory": "16g"})

    def once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    results, cold, extras, errors = {}, {}, {}, {}
    for name in names + extra:
        try:
            cold[name] = round(once(name), 3)
            median = round(statistics.median(once(name) for _ in range(runs)), 3)
        except Exception as exc:  # noqa: BLE001 - report and go on: one JSON line is always printed
            errors[name] = str(exc).splitlines()[0][:300]
            continue
        (results if name in names else extras)[name] = median
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "extra": extras,
        "cold": cold,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
