import random
from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakecart.operators import inventory

SCHEMA = ("event_id string, product_id string, store_id string, event_ts timestamp, on_hand int, "
          "available_to_promise int, reorder_point int, change_quantity int")


def test_latest_state_sample(spark):
    t = datetime(2026, 5, 2, 20, 24, 0)
    rows = [
        ("a", "K10", "oslo-1", t, 9, 9, 4, 1),
        ("b", "K11", "oslo-2", t, 31, 30, 12, 10),
        ("c", "K16", "bergen-1", t, 41, 40, 25, 2),
        ("d", "K16", "bergen-2", t + timedelta(seconds=52), 29, 28, 25, -4),
        ("e", "K16", "bergen-2", t + timedelta(seconds=10), 33, 32, 25, 3),
    ]
    g = inventory.inventory_gold(spark.createDataFrame(rows, SCHEMA))
    got = {(r.product_id, r.store_id): r.available_to_promise for r in g.collect()}
    assert got == {("K10", "oslo-1"): 9, ("K11", "oslo-2"): 30, ("K16", "bergen-1"): 40, ("K16", "bergen-2"): 28}
    assert inventory.inventory_alerts(g).count() == 0


def test_ties_broken_by_event_id(spark):
    t = datetime(2026, 5, 2)
    rows = [("x1", "P", "S", t, 5, 5, 1, 0), ("x2", "P", "S", t, 9, 9, 1, 0)]
    assert inventory.latest_state(spark.createDataFrame(rows, SCHEMA)).first().event_id == "x2"


def test_risk_levels(spark):
    t = datetime(2026, 5, 2)
    rows = [("1", "A", "S", t, 0, 0, 5, 0), ("2", "B", "S", t, 5, 5, 5, 0), ("3", "C", "S", t, 6, 6, 5, 0),
            ("4", "D", "S", t, 1, None, 5, 0), ("5", "E", "S", t, -2, -2, 5, 0)]
    g = {r.product_id: (r.inventory_risk_level, r.is_low_inventory)
         for r in inventory.inventory_gold(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert g == {"A": ("stockout", True), "B": ("reorder", True), "C": ("healthy", False),
                 "D": ("healthy", None), "E": ("stockout", True)}
    model = inventory.inventory_risk_model(spark.createDataFrame(rows, SCHEMA).withColumn("sku", F.lit("s")))
    assert model.columns == inventory.RISK_MODEL_COLUMNS and model.count() == 5


def _fold(initial, deltas):
    out, x = [], initial
    for d in deltas:
        x = max(0, x + d)
        out.append(x)
    return out


def _ledger_rows(seqs):
    rows, t0 = [], datetime(2026, 1, 1)
    for k, (init, deltas) in enumerate(seqs):
        for i, d in enumerate(deltas):
            rows.append((f"e{i:05d}", f"P{k}", "S", t0 + timedelta(minutes=i), 0, 0, init, d))
    return rows


def _check_ledger(spark, seqs, minutes, total_order=True):
    df = spark.createDataFrame(_ledger_rows(seqs), SCHEMA)
    led = inventory.stock_ledger(df, initial="reorder_point", bucket=60 * minutes, total_order=total_order)
    got = {}
    for r in led.orderBy("product_id", "event_ts").collect():
        got.setdefault(r.product_id, []).append(r.ledger_on_hand)
    want = {f"P{k}": _fold(init, deltas) for k, (init, deltas) in enumerate(seqs) if deltas}
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.lists(st.integers(-15, 12), min_size=1, max_size=40)),
                min_size=1, max_size=5))
def test_ledger_equals_sequential_fold(spark, seqs):
    _check_ledger(spark, seqs, minutes=7)


def test_ledger_hot_key_is_split_and_exact(spark):
    rnd = random.Random(7)
    hot = (5, [rnd.randint(-9, 8) for _ in range(3000)])            # one key holds most rows
    cold = [(rnd.randint(0, 9), [rnd.randint(-5, 5) for _ in range(rnd.randint(1, 20))]) for _ in range(20)]
    seqs = [hot] + cold
    df = spark.createDataFrame(_ledger_rows(seqs), SCHEMA)
    seg = df.withColumn("_seg", inventory.time_bucket(df, "event_ts", 60 * 200))
    largest = seg.groupBy("product_id", "store_id", "_seg").count().agg(F.max("count")).first()[0]
    assert largest == 200                                            # the hot key's 3000 rows are 15 buckets
    _check_ledger(spark, seqs, minutes=200)
    _check_ledger(spark, seqs, minutes=200, total_order=False)       # event ids are unique here


def test_ledger_keeps_null_keys_and_null_times(spark):
    t = datetime(2026, 1, 1)
    rows = [("a", None, "S", t, 0, 0, 0, -3), ("b", None, "S", t + timedelta(days=3), 0, 0, 0, 5),
            ("c", None, "S", t + timedelta(days=9), 0, 0, 0, -2), ("d", "P", None, t, 0, 0, 0, 4),
            ("e", "P", None, None, 0, 0, 0, 1), ("f", "", "S", t, 0, 0, 0, 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    led = inventory.stock_ledger(df)
    assert led.columns == [*df.columns, "ledger_on_hand"]
    assert {r.event_id: r.ledger_on_hand for r in led.collect()} == {"a": 0, "b": 5, "c": 3, "e": 1, "d": 5, "f": 7}


def test_ledger_ties_are_deterministic(spark):
    t = datetime(2026, 1, 1)
    rows = [(f"x{i}", "P", "S", t, 0, 0, 0, d) for i, d in enumerate([5, -9, 3, 4, -2])]   # all tie on event_ts
    rows = [(r[0] if i % 2 else "same", *r[1:]) for i, r in enumerate(rows)]            # and on event_id
    df = spark.createDataFrame(rows, SCHEMA)
    runs = {tuple(sorted((r.event_id, r.change_quantity, r.ledger_on_hand) for r in
                         inventory.stock_ledger(df, bucket=s).collect())) for s in (1, 60, 86_400)}
    assert len(runs) == 1


def test_latest_state_breaks_event_id_ties_by_bus_position(spark):
    t = datetime(2026, 5, 2)
    rows = [("same", "P", "S", t, 5, 5, 1, 0, 0, 10), ("same", "P", "S", t, 9, 9, 1, 0, 0, 11),
            ("same", "P", "S", t, 7, 7, 1, 0, 0, 3)]
    df = spark.createDataFrame(rows, SCHEMA + ", kafka_partition int, kafka_offset bigint")
    assert inventory.latest_state(df).first().kafka_offset == 11
