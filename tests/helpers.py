"""Test helpers: build bus records and envelopes from Python payloads."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from lakecart.sources import bus

NOW = datetime(2026, 5, 2, 21, 0, tzinfo=UTC)


def records(spark: SparkSession, topic: str, payloads: list, keys: list | None = None) -> DataFrame:
    rows = []
    for i, p in enumerate(payloads):
        text = p if (p is None or isinstance(p, str)) else json.dumps(p)
        key = (keys[i] if keys else f"k{i}")
        rows.append((key.encode() if key is not None else None, text.encode() if text is not None else None,
                     topic, 0, i, datetime(2026, 5, 2, 20, 0)))
    return spark.createDataFrame(rows, bus.BUS_RECORD_SCHEMA)


def envelope(spark: SparkSession, topic: str, payloads: list) -> DataFrame:
    return bus.envelope(records(spark, topic, payloads), ingested_at=NOW)


def order(**over):
    base = {"event_id": "ev-basket-7", "event_type": "order_created", "event_ts": "2026-05-02T12:00:00Z",
            "ingestion_ts": "2026-05-02T12:00:04Z", "order_id": "basket-7", "user_id": "shopper-31",
            "product_id": "K12", "sku": "headset-blue", "store_id": "oslo-2", "channel": "kiosk", "quantity": 3,
            "unit_price": 24.5, "order_total": 73.5, "currency": "NOK", "status": "packed"}
    base.update(over)
    return base


# An invented shop.
CATALOG_CSV = """product_id,sku,product_name,category,brand,base_price,cost,reorder_point
K10,oak-desk,Oak desk,Desks,Holz,420.00,260.00,4
K11,lamp-brass,Brass lamp,Lamps,Lumo,89.50,41.25,12
K12,tea-green,Green tea,Tea,Blatt,12.40,5.10,60
K13,mug-clay,Clay mug,Kitchen,Ton,18.00,7.75,40
K14,chair-ash,Ash chair,Chairs,Holz,210.00,128.00,6
K15,rug-wool,Wool rug,Rugs,Weft,340.00,199.90,3
K16,lamp-paper,Paper lamp,Lamps,Lumo,39.90,14.30,25
K17,kettle,Steel kettle,Kitchen,Ton,64.00,29.50,15
"""

SAMPLE_ORDERS = [
    # order_id, product, channel, qty, order_total, status
    ("basket-101", "K11", "kiosk", 1, 89.50, "cancelled"),
    ("basket-102", "K13", "kiosk", 1, 18.00, "created"),
    ("basket-103", "K15", "app", 1, 345.60, "paid"),
    ("basket-104", "K14", "kiosk", 2, 415.98, "paid"),
    ("basket-105", "K11", "phone", 1, 95.20, "created"),
]


def sample_order_payloads():
    out = []
    for i, (oid, pid, ch, q, total, st) in enumerate(SAMPLE_ORDERS):
        out.append(order(event_id=f"ev-{i}", order_id=oid, product_id=pid, channel=ch, quantity=q,
                         unit_price=round(total / q, 2), order_total=total, status=st,
                         event_ts=f"2026-05-02T20:2{i}:00Z", user_id=f"shopper-{i}"))
    return out
