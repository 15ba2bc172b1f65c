"""Hot-key check: a third of the inventory events moved onto one product × store.

Usage: python tools/skew_check.py [sf_dir]
Prints one JSON line: rows, hot-key rows, the largest (key, segment) group the
stock ledger creates (what one task sorts), and timings of latest_state and
stock_ledger on the skewed input next to the unskewed one.  The ledger result is
also compared with a plain per-key window (fine at this size, not at scale).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lakecart.operators import inventory  # noqa: E402
from lakecart.session import build_session  # noqa: E402
from lakecart.sources import testviews  # noqa: E402

KEYS, ORDER = ["product_id", "store_id"], ["event_ts", "event_id"]


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(master="local[8]", shuffle_partitions=8, conf={"spark.driver.memory": "8g"})
    inv = testviews.load_fixtures(spark, sf)["inventory"]
    hot = F.xxhash64("event_id") % 3 == 0                       # a third of all rows, chosen deterministically
    # a total order inside every key (the ledger's precondition): make event_id unique up to identical rows
    uid = F.concat_ws("-", "event_id", F.xxhash64(*inv.columns).cast("string"))
    skewed = (inv.withColumn("event_id", uid)
              .withColumn("product_id", F.when(hot, F.lit("HOT")).otherwise(F.col("product_id")))
              .withColumn("store_id", F.when(hot, F.lit("HOT")).otherwise(F.col("store_id"))))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = 30 * 86_400                                        # the fixture spreads few rows over seven years
    total, hot_rows = skewed.count(), skewed.filter(F.col("product_id") == "HOT").count()
    seg = skewed.withColumn("_seg", inventory.time_bucket(skewed, ORDER[0], bucket))
    largest = seg.groupBy(*KEYS, "_seg").count().agg(F.max("count")).first()[0]
    hot_segments = seg.filter(F.col("product_id") == "HOT").select("_seg").distinct().count()

    ledger = inventory.stock_ledger(skewed, initial=10, bucket=bucket)            # initial balance constant per key
    s = F.lit(10).cast("bigint") + F.sum("change_quantity").over(
        Window.partitionBy(*KEYS).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0))
    plain = skewed.withColumn("_s", s).withColumn("_m", F.min("_s").over(
        Window.partitionBy(*KEYS).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)))
    plain = plain.withColumn("ledger_on_hand", F.col("_s") - F.least(F.lit(0).cast("bigint"), F.col("_m")))
    cols = ["event_id", *KEYS, "ledger_on_hand"]
    mismatches = ledger.select(*cols).exceptAll(plain.select(*cols)).count()

    latest = inventory.latest_state(skewed)
    print(json.dumps({
        "sf": sf, "rows": total, "hot_key_rows": hot_rows, "segments": n,
        "ledger_hot_key_segments": hot_segments, "ledger_largest_group_rows": largest,
        "ledger_mismatches_vs_plain_window": mismatches,
        "latest_one_row_per_key": latest.count() == latest.select(*KEYS).distinct().count(),
        "seconds": {"latest_state": timed(latest), "latest_state_unskewed": timed(inventory.latest_state(inv)),
                    "stock_ledger": timed(ledger),
                    "stock_ledger_unskewed": timed(inventory.stock_ledger(inv, initial=10))},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
