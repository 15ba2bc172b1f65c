"""Streaming: watermark late-drop schedule, exactly-once resume, idempotent gold batches."""

import json
import os
import tempfile
import time
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import CATALOG_CSV, order
from lakecart.operators import gold
from lakecart.sinks.layout import Layout
from lakecart.sources.catalog import load_catalog
from lakecart.streaming.topic_streams import (DropListener, OrderGoldBatchWriter, StreamSettings, await_queries, start_topic,
                                              topic_source, watermark_drops)

ARROW_BUS = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()),
                       ("partition", pa.int32()), ("offset", pa.int64()), ("timestamp", pa.timestamp("us", tz="UTC"))])

# (batch, order_id, HH:MM) — delay for orders is 120 minutes
SCHEDULE = [
    (1, "A", "15:00"),
    (2, "L1", "12:30"), (2, "x", "15:01"),
    (3, "L2", "12:30"), (3, "A", "15:00"), (3, "y", "15:02"),
    (4, "L3", "13:00"), (4, "L4", "13:01"), (4, "L5", "12:59"),
]


def _write_batch(bus_dir, batch, rows, mtime):
    os.makedirs(bus_dir, exist_ok=True)
    recs = []
    for i, (oid, hhmm) in enumerate(rows):
        payload = order(event_id=f"{oid}-{batch}", order_id=oid, event_ts=f"2026-05-02T{hhmm}:00Z")
        recs.append({"key": oid.encode(), "value": json.dumps(payload).encode(), "topic": "orders",
                     "partition": 0, "offset": batch * 100 + i,
                     "timestamp": datetime(2026, 5, 2, 16, 0, tzinfo=timezone.utc)})
    path = os.path.join(bus_dir, f"batch-{batch}.parquet")
    pq.write_table(pa.Table.from_pylist(recs, schema=ARROW_BUS), path)
    os.utime(path, (mtime, mtime))


def _run(spark, base, catalog, shared=False):
    layout = Layout.under(base)
    settings = StreamSettings(layout=layout, available_now=True, catalog=catalog, shared_scan=shared,
                              now=datetime(2026, 5, 2, 21, 0, tzinfo=timezone.utc))
    src = topic_source(spark, "orders", "files", f"{base}/bus", max_files_per_trigger=1)
    queries = start_topic(src, "orders", settings)
    await_queries(spark, queries, drain=True)
    return layout, queries


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    p = tmp_path_factory.mktemp("cat") / "catalog.csv"
    p.write_text(CATALOG_CSV)
    return load_catalog(spark, str(p))


def test_late_drop_schedule_and_resume(spark, catalog):
    base = tempfile.mkdtemp(prefix="lakecart-stream-")
    bus_dir = f"{base}/bus/orders"
    t0 = 1_700_000_000
    for b in (1, 2):
        _write_batch(bus_dir, b, [(o, t) for bb, o, t in SCHEDULE if bb == b], t0 + b * 10)
    layout, qs = _run(spark, base, catalog)
    first_drops = watermark_drops(qs[1])
    silver = {r.order_id for r in spark.read.parquet(layout.table("silver", "orders")).collect()}
    assert silver == {"A", "L1", "x"}            # L1 survives: lateness is judged one batch behind
    assert first_drops == 0

    for b in (3, 4):                              # resume from the same checkpoints with new files
        _write_batch(bus_dir, b, [(o, t) for bb, o, t in SCHEDULE if bb == b], t0 + b * 10)
    layout, qs = _run(spark, base, catalog)
    silver = sorted(r.order_id for r in spark.read.parquet(layout.table("silver", "orders")).collect())
    assert silver == ["A", "L1", "x", "y"]        # A again is a duplicate; L2..L5 are behind the watermark
    assert watermark_drops(qs[1]) == 4            # L2 in batch 3, L3 L4 L5 in batch 4
    bronze = spark.read.parquet(layout.table("bronze", "orders"))
    assert bronze.count() == len(SCHEDULE)        # every record landed exactly once across both runs
    assert spark.read.parquet(layout.table("quarantine", "orders")).count() == 0
    inc = spark.read.parquet(layout.table("gold", "orders_gold_incremental"))
    assert sorted(r.order_id for r in inc.collect()) == ["A", "L1", "x", "y"]


def test_gold_batch_writer_is_idempotent(spark, catalog, tmp_path):
    layout = Layout.under(str(tmp_path))
    rows = [("O1", "K11", "2026-05-02 10:00:00", 2, 100.0, "web"), ("O2", "K99", "2026-05-02 11:00:00", 1, 5.0, "web")]
    orders = (spark.createDataFrame(rows, "order_id string, product_id string, event_ts string, quantity int, "
                                          "order_total double, channel string")
              .withColumn("event_ts", F.col("event_ts").cast("timestamp"))
              .withColumn("unit_price", F.col("order_total") / F.col("quantity"))
              .withColumn("user_id", F.lit("u")).withColumn("store_id", F.lit("s")).withColumn("status", F.lit("paid")))
    batch = gold.enrich_orders(orders, catalog)
    writer = OrderGoldBatchWriter(layout)
    writer(batch, 7)
    writer(batch, 7)                               # replay of the same micro-batch
    writer(batch.limit(0), 8)                      # empty batch: nothing written
    writer(batch.limit(1), 9)
    fact = spark.read.parquet(layout.table("gold", "orders_gold_incremental"))
    assert {r._batch_id: r.n for r in fact.groupBy("_batch_id").agg(F.count(F.lit(1)).alias("n")).collect()} == {7: 2, 9: 1}
    inc = spark.read.parquet(layout.table("gold", "revenue_daily_incremental"))
    assert inc.filter("_batch_id = 7").count() == 2
    assert set(fact.columns) == set(gold.ORDER_FACT_COLUMNS) | {"_batch_id"}


def test_shared_scan_mode_gives_the_same_tables(spark, catalog):
    base = tempfile.mkdtemp(prefix="lakecart-shared-")
    bus_dir = f"{base}/bus/orders"
    t0 = 1_700_000_000
    for b in (1, 2, 3, 4):
        _write_batch(bus_dir, b, [(o, t) for bb, o, t in SCHEDULE if bb == b], t0 + b * 10)
    layout, qs = _run(spark, base, catalog, shared=True)
    assert len(qs) == 2
    silver = sorted(r.order_id for r in spark.read.parquet(layout.table("silver", "orders")).collect())
    assert silver == ["A", "L1", "x", "y"]
    assert watermark_drops(qs[1]) == 4
    assert spark.read.parquet(layout.table("bronze", "orders")).count() == len(SCHEDULE)
    inc = spark.read.parquet(layout.table("gold", "orders_gold_incremental"))
    assert sorted(r.order_id for r in inc.collect()) == ["A", "L1", "x", "y"]


def test_drops_are_counted_beyond_the_retained_progress(spark, catalog):
    base, t0 = tempfile.mkdtemp(prefix="lakecart-drops-"), 1_700_000_000
    for b in range(1, 5):
        _write_batch(f"{base}/bus/orders", b, [(o, t) for bb, o, t in SCHEDULE if bb == b], t0 + b * 10)
    for b in range(5, 9):                          # nothing late any more: these push the drops out of the progress
        _write_batch(f"{base}/bus/orders", b, [(f"z{b}", "15:10")], t0 + b * 10)
    drops = DropListener()
    spark.streams.addListener(drops)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        _layout, qs = _run(spark, base, catalog)
        assert watermark_drops(qs[1]) == 0
        deadline = time.time() + 30                # progress events arrive a little after the query has ended
        while watermark_drops(qs[1], drops) < 4 and time.time() < deadline:
            time.sleep(0.2)
        assert watermark_drops(qs[1], drops) == 4
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(drops)


def test_orders_share_one_dedupe_by_default(spark, catalog):
    base = tempfile.mkdtemp(prefix="lakecart-default-")
    _write_batch(f"{base}/bus/orders", 1, [("A", "15:00"), ("A", "15:00"), ("B", "15:01")], 1_700_000_000)
    layout, qs = _run(spark, base, catalog, shared=None)
    assert len(qs) == 2
    silver = {(r.order_id, r.event_ts) for r in spark.read.parquet(layout.table("silver", "orders")).collect()}
    fact = {(r.order_id, r.event_ts) for r in
            spark.read.parquet(layout.table("gold", "orders_gold_incremental")).collect()}
    assert silver == fact and len(silver) == 2


def test_collapse_copies_before_dedupe(spark, catalog):
    from lakecart.operators import silver
    from helpers import envelope

    storm = [order(event_id=f"copy-{i}", order_id="HOT") for i in range(500)] + \
        [order(event_id=f"o{i}", order_id=f"O{i}") for i in range(20)]
    env = envelope(spark, "orders", storm)
    valid = silver.valid_rows(silver.silver_frame(env, "orders"))
    collapsed = silver.collapse_copies(valid, "orders")
    assert collapsed.filter("order_id = 'HOT'").count() <= collapsed.rdd.getNumPartitions()
    assert collapsed.count() - collapsed.filter("order_id = 'HOT'").count() == 20
    assert collapsed.columns == valid.columns

    base = tempfile.mkdtemp(prefix="lakecart-collapse-")
    rows = [("HOT", "15:00")] * 50 + [("A", "15:00"), ("B", "15:01")]
    _write_batch(f"{base}/bus/orders", 1, rows, 1_700_000_100)
    layout = Layout.under(base)
    settings = StreamSettings(layout=layout, available_now=True, catalog=catalog, collapse_copies=True)
    await_queries(spark, start_topic(topic_source(spark, "orders", "files", f"{base}/bus"), "orders", settings),
                  drain=True)
    got = sorted(r.order_id for r in spark.read.parquet(layout.table("silver", "orders")).collect())
    assert got == ["A", "B", "HOT"]


def test_topic_start_is_all_or_none(spark, catalog, tmp_path):
    bus_dir = tmp_path / "bus" / "orders"
    _write_batch(str(bus_dir), 1, [("A", "15:00")], 1_700_000_200)
    layout = Layout(root=str(tmp_path / "lake"), checkpoint_root=str(tmp_path / "ck"))
    (tmp_path / "lake" / "silver").mkdir(parents=True)
    (tmp_path / "lake" / "silver" / "orders").write_text("not a folder")       # the silver sink cannot start
    settings = StreamSettings(layout=layout, processing_time="1 second", catalog=catalog, shared_scan=False)
    before = {q.id for q in spark.streams.active}
    with pytest.raises(Exception):
        start_topic(topic_source(spark, "orders", "files", str(tmp_path / "bus")), "orders", settings)
    assert {q.id for q in spark.streams.active} == before                        # bronze was stopped again


def test_tables_are_written_with_zstd(spark, tmp_path):
    from lakecart.sinks.writers import publish_to_files, replace_partitions, write_overwrite, write_stream

    df = spark.range(100).selectExpr("id", "repeat('{\"a\":1}', 9) AS value", "id % 2 AS part")
    publish_to_files(df, f"{tmp_path}/bus")
    write_overwrite(df, f"{tmp_path}/whole")
    replace_partitions(df, f"{tmp_path}/parts", ["part"])
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/bus")
    write_stream(stream, f"{tmp_path}/stream", f"{tmp_path}/ck", available_now=True).awaitTermination()
    files = [f for n in ("bus", "whole", "parts", "stream") for f in (tmp_path / n).rglob("*.parquet")]
    assert len(files) >= 4
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_dedupe_moves_payloads_without_their_fields(spark, catalog, tmp_path):
    from lakecart.streaming.topic_streams import topic_frames

    _write_batch(f"{tmp_path}/bus/orders", 1, [("A", "15:00")], time.time())
    src = topic_source(spark, "orders", "files", f"{tmp_path}/bus")
    plan = topic_frames(src, "orders", StreamSettings(layout=Layout.under(str(tmp_path)), catalog=catalog))["silver"] \
        ._jdf.queryExecution().analyzed().toString()
    below = plan[plan.index("Deduplicate"):].splitlines()[1]      # its input, topmost projection or watermark
    carried = plan[plan.index("Deduplicate"):].split("Project")[1].splitlines()[0]
    assert "payload" in carried and "unit_price" not in carried, (below, carried)


def test_raw_batches_are_not_held(spark, tmp_path):
    from helpers import records
    from lakecart.sources import bus
    from lakecart.streaming.topic_streams import RawBatchWriter

    layout = Layout.under(str(tmp_path))
    batch = bus.envelope(records(spark, "orders", [order(), "{cut", order(order_id=None)]), ingested_at="2026-05-02 21:00:00")
    held = []
    batch.persist = lambda *a: held.append(a) or batch
    for _ in range(2):                                              # a replay replaces both partitions
        RawBatchWriter("orders", StreamSettings(layout=layout, now=datetime(2026, 5, 2, 21, 0, tzinfo=timezone.utc)))(batch, 3)
    assert not held
    assert spark.read.parquet(layout.table("bronze", "orders")).count() == 3
    bad = spark.read.parquet(layout.table("quarantine", "orders"))
    assert sorted(r.payload[:4] for r in bad.collect()) == ['{"ev', "{cut"]
