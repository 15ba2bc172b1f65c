"""Results carried over batches and runs: additive distinct counts, late rows, the continuing ledger, the latest state."""

from __future__ import annotations

import random
import tempfile
from datetime import UTC, date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import CATALOG_CSV, order, records
from lakecart.operators import additive, gold, inventory
from lakecart.operators.ledger_store import LedgerStore
from lakecart.sinks.layout import Layout
from lakecart.sinks.writers import publish_to_files
from lakecart.sources.catalog import load_catalog
from lakecart.streaming.topic_streams import (
    StreamSettings, await_queries, compact_latest_inventory, read_latest_inventory, start_latest_inventory, start_topic, topic_source,
)

NOW = datetime(2026, 5, 2, 21, 0, tzinfo=UTC)


# ---- additive revenue ------------------------------------------------------------

ENRICHED = ("event_ts timestamp, category string, channel string, order_id string, quantity int, order_total double, "
            "gross_margin double, product_id string, product_name string, brand string, cost double, user_id string, "
            "store_id string, unit_price double, status string")


def _sales(n=400, hot=150):
    rnd, t0 = random.Random(3), datetime(2026, 1, 30)
    rows = []
    for i in range(n):
        day = t0 + timedelta(days=0 if i < hot else rnd.randint(0, 5), hours=rnd.randint(0, 23))
        rows.append((day if i % 50 else None, rnd.choice(["a", "b", None]), rnd.choice(["web", "kiosk"]),
                     f"o{rnd.randint(0, 60)}" if i % 17 else None, rnd.randint(1, 4), rnd.randint(1, 9999) / 100,
                     rnd.randint(-500, 900) / 100, "p", "n", "b", 1.0, "u", "s", 1.0, "paid"))
    return rows


def _table(df, *keys):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("by", [None, ["order_date"], ["order_date", "channel"]])
def test_increments_alone_give_the_day_totals(spark, tmp_path, by):
    rows = _sales()
    writer = additive.AdditiveRevenueWriter(Layout.under(str(tmp_path)), buckets=4)
    for batch, chosen in ((0, rows[::3]), (1, rows[1::3]), (2, []), (5, rows[2::3]), (1, rows[1::3]), (5, rows[2::3])):
        writer(spark.createDataFrame(chosen, ENRICHED), batch)  # the last two are replays
    whole = spark.createDataFrame(rows, ENRICHED).withColumn("order_date", F.to_date("event_ts"))
    want = whole.groupBy(*(by or gold.REVENUE_DAILY_KEY)).agg(*gold._sales_metrics())
    assert _table(writer.totals(spark, by)) == _table(want)


def test_numbers_are_dense_within_a_day_and_replays_keep_them(spark, tmp_path):
    writer = additive.AdditiveRevenueWriter(Layout.under(str(tmp_path)), buckets=2)
    day = [(datetime(2026, 3, 1), "a", "web", f"o{i:03}", 1, 1.0, 1.0, "p", "n", "b", 1.0, "u", "s", 1.0, "x") for i in range(200)]
    writer(spark.createDataFrame(day[:120], ENRICHED), 0)
    writer(spark.createDataFrame(day[60:], ENRICHED), 1)
    numbers = {(r.order_id, r._batch_id): r.order_no for r in spark.read.parquet(writer.numbers).collect()}
    assert len(numbers) == 200 and len(set(numbers.values())) == 200 and min(numbers.values()) >= 1
    assert max(numbers.values()) < 2 * 130  # two sequences of about a hundred
    writer(spark.createDataFrame(day[:120], ENRICHED), 0)
    assert {(r.order_id, r._batch_id): r.order_no for r in spark.read.parquet(writer.numbers).collect()} == numbers


def test_bitmaps_are_cut_and_reach_past_one_bucket(spark):
    n = 70_000
    sales = spark.range(n).select(F.lit(date(2026, 3, 1)).alias("order_date"), F.lit("a").alias("category"),
                                  F.when(F.col("id") % 2 == 0, "web").otherwise("kiosk").alias("channel"),
                                  F.concat(F.lit("o"), F.col("id") % 50_000).alias("order_id"), F.lit(1).alias("quantity"),
                                  F.lit(0.1).alias("order_total"), F.lit(0.1).alias("gross_margin"))
    ids = sales.select("order_date", "order_id").distinct()
    inc = additive.increment(sales, additive.number_ids(ids, None)).persist()
    assert inc.where("bucket > 1").count() > 0 and inc.agg(F.max(F.length("bits"))).first()[0] <= 4096
    total = additive.additive_totals(inc, ["order_date"]).first()
    assert (total.orders, total.units_sold, total.revenue) == (50_000, n, 7000.0)
    with pytest.raises(ValueError):
        additive.additive_totals(inc, ["category"])


def test_no_bitmap_is_shuffled_before_it_is_cut(spark):
    sales = spark.createDataFrame(_sales(), ENRICHED).withColumn("order_date", F.to_date("event_ts"))
    ids = sales.where("order_id is not null").select("order_date", "order_id").distinct()
    inc = additive.increment(sales, additive.number_ids(ids, None, 4))
    plan = inc._jdf.queryExecution().executedPlan().toString().splitlines()
    partial = [i for i, x in enumerate(plan) if "partial_bitmap_construct_agg" in x]
    assert partial and not any("Exchange" in plan[i - 1] for i in partial)
    of_rows = [x for x in plan if "Join" in x or "Exchange" in x]
    assert of_rows and not any("order_total" in x or "quantity" in x for x in of_rows)
    rows = inc.collect()
    groups = {(r.order_date, r.category, r.channel) for r in sales.collect()}
    summed = [r for r in rows if r.bucket is None]
    assert sorted(map(repr, groups)) == sorted(repr((r.order_date, r.category, r.channel)) for r in summed)
    assert sum(r.units_sold for r in summed) == sum(r.quantity for r in sales.collect())
    assert all(r.bits == b"" for r in summed)
    assert all(r.units_sold is None and r.bits for r in rows if r.bucket is not None)


def test_a_writer_computes_a_batch_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    batch = spark.createDataFrame(_sales(60), ENRICHED).withColumn("order_id", counted("order_id"))
    additive.AdditiveRevenueWriter(Layout.under(str(tmp_path)))(batch, 0)
    assert seen.value == 60


# ---- late rows -------------------------------------------------------------------

def _drain(spark, base, topic, **options):
    layout = Layout.under(base)
    settings_ = StreamSettings(layout=layout, available_now=True, now=NOW, **options)
    source = topic_source(spark, topic, "files", f"{base}/bus", ingested_at=NOW)
    await_queries(spark, start_topic(source, topic, settings_), drain=True)
    return layout


def test_every_valid_row_is_silver_a_copy_or_late(spark, tmp_path):
    csv = tmp_path / "catalog.csv"
    csv.write_text(CATALOG_CSV)
    catalog, base = load_catalog(spark, str(csv)), tempfile.mkdtemp(prefix="lakecart-late-")
    at = lambda oid, hhmm, n=0: order(event_id=f"{oid}-{n}", order_id=oid, event_ts=f"2026-05-02T{hhmm}:00Z")
    drains = [[at("A", "15:00"), at("A", "15:00", 1)],
              [at("L", "13:00"), at("L", "13:00", 1), at("x", "13:01"), at("A", "15:00", 2), at("y", "15:05"), {"order_id": "bad"}],
              [at("M", "13:05"), at("x", "13:06", 3), at("z", "16:00")], []]
    for i, payloads in enumerate(drains):
        if payloads:
            publish_to_files(records(spark, "orders", payloads, [f"{i}-{j}" for j in range(len(payloads))]), f"{base}/bus/orders")
        layout = _drain(spark, base, "orders", keep_late=True, catalog=catalog)
    read = lambda layer, name="orders": spark.read.parquet(layout.table(layer, name))
    # in force: none, 13:00, 13:05; a row at the watermark is late; x at 13:06 is a key of its own
    assert sorted((r.order_id, r.event_ts.strftime("%H:%M")) for r in read("silver").collect()) == [
        ("A", "15:00"), ("x", "13:01"), ("x", "13:06"), ("y", "15:05"), ("z", "16:00")]
    assert sorted(r.event_id for r in read("late").collect()) == ["L-0", "L-1", "M-0"]
    assert read("silver").where("order_id = 'A'").first().event_id == "A-0"
    assert read("quarantine").count() == 1 and read("bronze").count() == sum(map(len, drains))
    assert sorted(r.order_id for r in read("gold", "orders_gold_incremental").collect()) == ["A", "x", "x", "y", "z"]


# ---- the ledger over runs ----------------------------------------------------------

EVENTS = "event_id string, product_id string, store_id string, event_ts timestamp, change_quantity int, reorder_point int"


def _continued(spark, path, runs, bucket=3600):
    store = LedgerStore(path, initial="reorder_point", bucket=bucket)
    for n, rows in enumerate(runs):
        store.append(spark.createDataFrame(rows, EVENTS), n)
    return store


def _both(spark, path, runs, bucket=3600):
    store = _continued(spark, path, runs, bucket)
    whole = spark.createDataFrame([r for run in runs for r in run], EVENTS)
    want = inventory.stock_ledger(whole, initial="reorder_point", bucket=bucket)
    return store, _table(store.ledger(spark)), _table(want)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 9 * 3600), st.integers(-6, 6)), min_size=1, max_size=12),
                min_size=2, max_size=3))
def test_runs_equal_one_run(spark, runs):
    t0 = datetime(2026, 5, 1)
    rows = [[(f"e{n}-{i}", ["P", None][k], "S", t0 + timedelta(seconds=s), d, 3) for i, (k, s, d) in enumerate(run)]
            for n, run in enumerate(runs)]
    _, got, want = _both(spark, tempfile.mkdtemp(prefix="lakecart-ledger-"), rows)
    assert got == want


def test_ledger_appends_late_events_repeats_and_replays(spark, tmp_path):
    t0 = datetime(2026, 5, 1)
    row = lambda i, minute, d, p="P": (f"e{i}", p, "S", None if minute is None else t0 + timedelta(minutes=minute), d, 2)
    first = [row(1, 5, -4), row(2, 50, 7), row(3, 70, -9), row(4, None, 2), row(5, 10, 1, "Q")]
    second = [row(6, 55, -1), row(7, 130, 3), row(7, 130, 3)]  # bucket 0 grows at its end; an exact copy
    third = [row(8, 7, -3), row(9, 71, None)]  # between the events of bucket 0; after those of bucket 1
    store, got, want = _both(spark, str(tmp_path / "l"), [first, second, third])
    assert got == want
    segments = {(r._seg, r._run): r.from_run for r in spark.read.parquet(store.segs_path).where("_k1 = 'P'").collect()}
    zero = int(t0.replace(tzinfo=UTC).timestamp()) // 3600
    assert segments[(zero, 0)] == 0 and segments[(zero, 1)] == 0 and segments[(zero, 2)] == 2  # begun again
    assert segments[(zero + 1, 2)] == 0  # continued from its summary
    written = spark.read.parquet(store.rows_path)
    assert written.where("_run = 1").count() == 3 and written.where("_run = 2").count() == 5
    store.append(spark.createDataFrame(third, EVENTS), 2)
    assert _table(store.ledger(spark)) == want
    store.append(spark.createDataFrame([], EVENTS), 3)
    assert _table(store.ledger(spark)) == want


# ---- latest state as a stream --------------------------------------------------------

def _stock(i, product, minute, available, event_id=None):
    return {"event_id": event_id or f"i{i}", "event_type": "inventory_update", "event_ts": f"2026-05-02T10:{minute:02}:00Z",
            "ingestion_ts": "2026-05-02T12:00:00Z", "product_id": product, "sku": "s", "store_id": "oslo", "on_hand": available,
            "available_to_promise": available, "reorder_point": 5, "change_quantity": 1, "reason": "sale"}


def test_latest_state_over_drains(spark):
    base = tempfile.mkdtemp(prefix="lakecart-latest-")
    layout = Layout.under(base)
    drains = [[_stock(0, "A", 5, 9), _stock(1, "B", 5, 4), _stock(2, "C", 1, 0)],
              [_stock(3, "A", 4, 1), _stock(4, "B", 9, 7)],                        # A older: no change
              [_stock(5, "C", 1, 8, "i1"), _stock(6, "C", 1, 3, "i7"), _stock(7, "D", 0, 6)]]  # ties go to the larger event id
    for i, payloads in enumerate(drains):
        publish_to_files(records(spark, "inventory", payloads).withColumn("offset", F.col("offset") + 10 * i), f"{base}/bus/inventory")
        source = topic_source(spark, "inventory", "files", f"{base}/bus", ingested_at=NOW)
        await_queries(spark, [start_latest_inventory(source, StreamSettings(layout=layout, available_now=True, now=NOW))], drain=True)
        if i == 1:
            compact_latest_inventory(spark, layout)
            compact_latest_inventory(spark, layout)
    state = {r.product_id: (r.available_to_promise, r.event_id, r.inventory_risk_level) for r in
             read_latest_inventory(spark, layout).collect()}
    assert state == {"A": (9, "i0", "healthy"), "B": (7, "i4", "healthy"), "C": (3, "i7", "reorder"), "D": (6, "i7", "healthy")}


def test_latest_state_keeps_no_streaming_state(spark):
    from lakecart.streaming.topic_streams import latest_inventory_stream

    base = tempfile.mkdtemp(prefix="lakecart-latest-")
    publish_to_files(records(spark, "inventory", [_stock(0, "A", 5, 9)]), f"{base}/bus/inventory")
    source = topic_source(spark, "inventory", "files", f"{base}/bus", ingested_at=NOW)
    plan = latest_inventory_stream(source, StreamSettings(layout=Layout.under(base), now=NOW))._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" not in plan


def test_latest_state_folded_twice(spark):
    layout = Layout.under(tempfile.mkdtemp(prefix="lakecart-latest-"))
    base = layout.root
    for i, (minute, available) in enumerate([(5, 9), (1, 2), (3, 4), (7, 1)]):
        publish_to_files(records(spark, "inventory", [_stock(i, "A", minute, available), _stock(10 + i, f"N{i}", 0, i)]),
                         f"{base}/bus/inventory")
        source = topic_source(spark, "inventory", "files", f"{base}/bus", ingested_at=NOW)
        await_queries(spark, [start_latest_inventory(source, StreamSettings(layout=layout, available_now=True, now=NOW))], drain=True)
        if i < 3:
            compact_latest_inventory(spark, layout)
    state = {r.product_id: (r.event_id, r.available_to_promise) for r in read_latest_inventory(spark, layout).collect()}
    assert state == {"A": ("i3", 1), "N0": ("i10", 0), "N1": ("i11", 1), "N2": ("i12", 2), "N3": ("i13", 3)}


def test_ledger_finds_touched_buckets_once_a_run(spark, tmp_path):
    schema = "event_id string, product_id string, store_id string, event_ts timestamp, change_quantity int"
    day = lambda i, d: (f"e{i}", "A", "s", datetime(2026, 5, d), 1)
    store = LedgerStore(str(tmp_path))
    for run, rows in enumerate([[day(0, 1), day(1, 2)], [day(2, 2), day(3, 3)], [day(4, 1)]]):
        store.append(spark.createDataFrame(rows, schema), run)
    assert [r.ledger_on_hand for r in store.ledger(spark).orderBy("event_ts", "event_id").collect()] == [1, 2, 3, 4, 5]
    assert [spark.read.parquet(f"{tmp_path}/touched/run={r}").count() for r in (1, 2)] == [2, 1]
