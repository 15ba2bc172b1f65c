"""Write the physical plans of the headline queries to docs/PLANS.md.

Usage: python tools/explain.py [sf_dir]   (static plans: AQE off while explaining)
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakecart.plans.registry import QUERIES  # noqa: E402
from lakecart.session import build_session  # noqa: E402

NAMES = ["enrich_orders", "revenue_daily", "top_products", "inventory_latest", "dedupe_orders",
         "silver_clickstream", "strict_type_errors", "stock_ledger"]


def _stream_plan(spark, sf: str) -> list[str]:
    """The orders silver stream: file bus → envelope → parse/quality → split → watermark + dedupe → catalog join."""
    import io
    import tempfile
    from contextlib import redirect_stdout

    from lakecart.sinks.layout import Layout
    from lakecart.sources import testviews
    from lakecart.streaming.topic_streams import StreamSettings, topic_frames, topic_source

    bus_dir = tempfile.mkdtemp(prefix="lakecart-explain-")
    os.makedirs(f"{bus_dir}/orders")
    settings = StreamSettings(layout=Layout.under(bus_dir), catalog=testviews.load_fixtures(spark, sf)["catalog"])
    frames = topic_frames(topic_source(spark, "orders", "files", bus_dir), "orders", settings)
    buf = io.StringIO()
    with redirect_stdout(buf):
        frames["silver"].explain()
    return ["## stream: orders silver (before start)", "", "```", buf.getvalue().rstrip(), "```", ""]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/explain.py` on `{sf}` with AQE off (static plans). "
           "Node details (`ReadSchema`, `PushedFilters`) are in the scan lines.", ""]
    for name in NAMES:
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", "", "```", plan.rstrip(), "```", ""]
    out += _stream_plan(spark, sf)
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
