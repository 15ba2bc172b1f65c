"""End to end through the command line: JSON lines → publish gate → file bus → stream → gold → models → health."""

import json

from helpers import CATALOG_CSV, order, sample_order_payloads
from lakecart.cli import main


def _inventory(i, pid, store, ts, atp, rp):
    return {"event_id": f"inv-{i}", "event_type": "inventory_update", "event_ts": ts, "ingestion_ts": ts,
            "product_id": pid, "sku": "x", "store_id": store, "on_hand": atp + 1, "available_to_promise": atp,
            "reorder_point": rp, "change_quantity": 1, "reason": "sale"}


def test_end_to_end(spark, tmp_path):
    inp, bus, lake, ck = (str(tmp_path / n) for n in ("in", "bus", "lake", "ck"))
    (tmp_path / "in").mkdir()
    orders = sample_order_payloads() + [order(event_id="bad", quantity="7")]        # gated out
    (tmp_path / "in" / "orders.jsonl").write_text("\n".join(json.dumps(o) for o in orders) + "\n")
    inv = [_inventory(0, "K10", "oslo-1", "2026-05-02T20:00:00Z", 0, 8),
           _inventory(1, "K11", "oslo-2", "2026-05-02T20:00:00Z", 12, 12),
           _inventory(2, "K11", "oslo-2", "2026-05-02T19:00:00Z", 50, 12),
           _inventory(3, "K16", "bergen-1", "2026-05-02T20:00:00Z", 40, 25)]
    (tmp_path / "in" / "inventory.jsonl").write_text("\n".join(json.dumps(o) for o in inv) + "\n")
    cat = tmp_path / "catalog.csv"
    cat.write_text(CATALOG_CSV)

    assert main(["publish", "--input", inp, "--topics", "orders,inventory", "--bus", "files", "--location", bus]) == 0
    assert spark.read.parquet(f"{bus}/orders").count() == 5
    common = ["--lakehouse-root", lake, "--checkpoint-root", ck]
    assert main(["stream", "--source", "files", "--location", bus, "--topics", "orders,inventory",
                 "--catalog", str(cat), "--available-now", *common]) == 0
    assert main(["refresh", *common]) == 0
    daily = {(r.category, r.channel): r.revenue for r in spark.read.parquet(f"{lake}/gold/revenue_daily").collect()}
    assert daily[("Chairs", "kiosk")] == 415.98 and len(daily) == 5
    alerts = {r.product_id: r.inventory_risk_level for r in spark.read.parquet(f"{lake}/gold/inventory_alerts").collect()}
    assert alerts == {"K10": "stockout", "K11": "reorder"}
    assert main(["models", "--catalog", str(cat), *common]) == 0
    assert main(["health", "--contents", "--output", str(tmp_path / "health"), *common]) == 0
    health = spark.read.json(str(tmp_path / "health"))
    assert health.filter("kind = 'table' AND layer = 'gold' AND table = 'revenue_daily'").count() == 1
    assert health.filter("layer = 'silver' AND table = 'orders' AND kind = 'table'").first().rows == 5
    assert main(["health", "--layers", "gold", "--output", str(tmp_path / "health_gold"), *common]) == 0
    assert {r.layer for r in spark.read.json(str(tmp_path / "health_gold")).collect()} == {"gold"}


def test_refresh_partitioned_by_date(spark, tmp_path):
    from helpers import envelope
    from lakecart.operators import gold, silver
    from lakecart.plans.gold_refresh import refresh
    from lakecart.sinks.layout import Layout
    from lakecart.sources.catalog import load_catalog

    cat = tmp_path / "catalog.csv"
    cat.write_text(CATALOG_CSV)
    payloads = sample_order_payloads()
    payloads[1]["event_ts"] = "2026-05-03T08:00:00Z"
    sil = silver.valid_rows(silver.silver_frame(envelope(spark, "orders", payloads), "orders"))
    lay = Layout.under(str(tmp_path))
    gold.enrich_orders(sil, load_catalog(spark, str(cat))).write.parquet(lay.table("silver", "orders"))
    written = refresh(spark, lay, partition_by_date=True)
    assert set(written) == {"orders_gold", "revenue_daily", "top_products"}      # no inventory silver: skipped
    dates = sorted(p.name for p in (tmp_path / "lakehouse" / "gold" / "orders_gold").iterdir() if p.is_dir())
    assert dates == ["order_date=2026-05-02", "order_date=2026-05-03"]
    daily = spark.read.parquet(written["revenue_daily"])
    assert daily.count() == 5 and round(sum(r.revenue for r in daily.collect()), 2) == 964.28


def test_publish_assigns_partitions_by_key(spark, tmp_path):
    inp = tmp_path / "in"
    inp.mkdir()
    events = [order(event_id=f"e{i}", order_id=f"O{i}") for i in range(30)]
    (inp / "orders.jsonl").write_text("\n".join(json.dumps(e) for e in events) + "\n")
    bus = str(tmp_path / "bus")
    assert main(["publish", "--input", str(inp), "--topics", "orders", "--bus", "files", "--location", bus,
                 "--partitions", "3"]) == 0
    rows = spark.read.parquet(f"{bus}/orders").select("key", "partition").collect()
    assert len(rows) == 30 and {r.partition for r in rows} <= {0, 1, 2} and len({r.partition for r in rows}) > 1
    by_key = {}
    for r in rows:
        by_key.setdefault(bytes(r.key), set()).add(r.partition)
    assert all(len(p) == 1 for p in by_key.values())                 # a key always lands on one partition
