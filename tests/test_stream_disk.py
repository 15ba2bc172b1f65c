"""What streams hold and move: batches are written once, joins and dedupes move records, shuffle files go early."""

import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from helpers import CATALOG_CSV, envelope, order, records
from lakecart.operators import gold, silver
from lakecart.sinks.layout import Layout
from lakecart.sinks.writers import publish_to_files, write_stream
from lakecart.sources import testviews
from lakecart.sources.catalog import load_catalog
from lakecart.sources.tables import read_table_if_exists
from lakecart.streaming import topic_streams
from lakecart.streaming.topic_streams import CleanBatchWriter, OrderGoldBatchWriter, StreamSettings

NOW = datetime(2026, 5, 2, 21, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    p = tmp_path_factory.mktemp("cat") / "catalog.csv"
    p.write_text(CATALOG_CSV)
    return load_catalog(spark, str(p))


def _stream(spark, path, payloads):
    from lakecart.sources import bus

    publish_to_files(records(spark, "orders", payloads), f"{path}/bus/orders")
    return bus.envelope(bus.file_bus_stream(spark, f"{path}/bus/orders"), NOW)


def _shuffles(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {b for b in blocks.split() if b.startswith("shuffle_")}


def _gone(spark, before: set[str]) -> bool:
    until = time.time() + 20
    while _shuffles(spark) - before and time.time() < until:
        time.sleep(0.2)
    return not _shuffles(spark) - before


@pytest.mark.parametrize("additive", [False, True])
def test_deduped_batches_are_not_held(spark, catalog, tmp_path, additive):
    layout = Layout.under(str(tmp_path))
    env = envelope(spark, "orders", [order(), order(event_id="b", order_id="b2", product_id="K13"), order(order_id="b3", product_id="zz")])
    batch = gold.enrich_orders(silver.silver_frame(env, "orders", now=NOW), catalog)
    held = []
    batch.persist = lambda *a: held.append(a) or batch
    settings = StreamSettings(layout=layout, now=NOW, catalog=catalog, additive_revenue=additive)
    for _ in range(2):                                              # a replay replaces the partitions
        CleanBatchWriter("orders", settings)(batch, 4)
    OrderGoldBatchWriter(layout)(batch, 5)
    assert not held
    written = spark.read.parquet(layout.table("silver", "orders"))
    assert written.drop("_batch_id").columns == batch.columns
    assert written.drop("_batch_id").exceptAll(batch).isEmpty() and written.count() == 3
    fact = spark.read.parquet(layout.table("gold", "orders_gold_incremental"))
    assert fact.where("_batch_id = 4").drop("_batch_id").exceptAll(gold.orders_fact(batch)).isEmpty() and fact.count() == 6
    want = gold.revenue_increment(batch, 4).where("_batch_id = 4")
    got = spark.read.parquet(layout.table("gold", "revenue_daily_incremental")).where("_batch_id = 4").select(*want.columns)
    assert got.count() == 3 and got.exceptAll(want).isEmpty()
    assert (read_table_if_exists(spark, layout.table("gold", "revenue_daily_additive")) is not None) == additive


def test_a_batch_without_rows_leaves_no_table(spark, catalog, tmp_path):
    layout = Layout.under(str(tmp_path))
    batch = gold.enrich_orders(silver.silver_frame(envelope(spark, "orders", [order()]), "orders", now=NOW), catalog)
    settings = StreamSettings(layout=layout, now=NOW, catalog=catalog)
    CleanBatchWriter("orders", settings)(batch.limit(0), 0)
    assert read_table_if_exists(spark, layout.table("silver", "orders")) is None
    assert read_table_if_exists(spark, layout.table("gold", "orders_gold_incremental")) is None
    CleanBatchWriter("orders", settings)(batch, 1)
    CleanBatchWriter("orders", settings)(batch.limit(0), 2)
    assert spark.read.parquet(layout.table("silver", "orders")).count() == 1


def _rows(df) -> list[str]:
    return sorted(map(str, df.collect()))


def _below(plan: str, node: str) -> str:
    """The first projection under a node."""
    return plan[plan.index(node):].split("Project")[1].splitlines()[0]


def test_catalog_join_moves_records(spark, catalog, tmp_path):
    src = _stream(spark, tmp_path, [order()])
    settings = StreamSettings(layout=Layout.under(str(tmp_path)), now=NOW, catalog=catalog, broadcast_max_rows=1)
    plan = topic_streams.topic_frames(src, "orders", settings)["silver"]._jdf.queryExecution().analyzed().toString()
    under = _below(plan, "Join LeftOuter")
    assert "payload" in under and "unit_price" not in under and "_dq_errors" not in under


def test_gold_query_moves_no_payload(spark, catalog, tmp_path):
    src = _stream(spark, tmp_path, [order()])
    settings = StreamSettings(layout=Layout.under(str(tmp_path)), now=NOW, catalog=catalog)
    plan = topic_streams.sold_orders(src, settings)._jdf.queryExecution().analyzed().toString()
    under = _below(plan, "Deduplicate")
    assert "unit_price" in under and "payload" not in under


def test_silver_keeps_its_columns_and_values(spark, catalog, tmp_path):
    """As parsed, enriched and flagged in one go, with the catalog broadcast or merged."""
    payloads = [order(), order(event_id="b", order_id="b2", product_id="K13"), order(order_id="b3", product_id="zz"), "{cut"]
    env = envelope(spark, "orders", payloads)
    want = gold.enrich_orders(silver.valid_rows(silver.silver_frame(env, "orders", now=NOW)), catalog)
    for most in (1, 100):
        settings = StreamSettings(layout=Layout.under(str(tmp_path)), now=NOW, catalog=catalog, broadcast_max_rows=most)
        got = topic_streams.topic_frames(env, "orders", settings)["silver"]
        assert got.columns == want.columns and got.schema.simpleString() == want.schema.simpleString()
        assert got.count() == 3 and _rows(got) == _rows(want)


def test_bus_keys_travel_packed(spark):
    keys = ["ab", "AB", "abc", "", None, "zz", "79e0e7aa" * 8, "ü", "a b"]
    env = envelope(spark, "orders", [order(order_id=f"o{i}") for i in range(len(keys))])
    names = F.array(*[F.lit(k) for k in keys])
    env = env.withColumn("kafka_key", names[F.col("kafka_offset").cast("int")])
    valid = silver.silver_frame(env, "orders", now=NOW)
    moved = silver.records_behind(valid, "orders")
    assert moved.agg(F.max(F.octet_length("kafka_key"))).first()[0] == 33             # of 64 hexadecimal digits
    back = silver.parsed_again(moved, "orders", NOW)
    assert back.columns == valid.columns
    assert sorted(map(str, (r.kafka_key for r in back.collect()))) == sorted(map(str, keys))
    assert _rows(back) == _rows(valid)


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    flag = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(flag, None), _shuffles(spark)
    dealt = records(spark, "orders", [order(order_id=f"o{i}") for i in range(50)]).repartition(3, "key")
    publish_to_files(dealt, f"{tmp_path}/bus")
    assert _gone(spark, before)
    assert spark.conf.get(flag, None) == was                          # other work of the session goes by its own settings
    assert dealt.count() == 50


def test_shuffle_files_of_ended_streams_go(spark, tmp_path):
    from lakecart.session import free_unreferenced

    rows = records(spark, "orders", [order(order_id=f"o{i}") for i in range(50)])
    publish_to_files(rows, f"{tmp_path}/bus")
    before = _shuffles(spark)
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/bus").dropDuplicates(["key"])
    query = write_stream(stream, f"{tmp_path}/out", f"{tmp_path}/ck", available_now=True)
    query.awaitTermination()
    assert _shuffles(spark) - before
    del query, stream
    free_unreferenced(spark)
    assert _gone(spark, before)


def test_written_batches_free_their_shuffles_before_gold(spark, catalog, tmp_path, monkeypatch):
    src = _stream(spark, tmp_path, [order(order_id=f"o{i}") for i in range(40)])
    before, seen = _shuffles(spark), []
    monkeypatch.setattr(topic_streams.OrderGoldBatchWriter, "__call__", lambda self, df, b: seen.append((_gone(spark, before), df.count())))
    settings = StreamSettings(layout=Layout.under(str(tmp_path)), now=NOW, catalog=catalog, available_now=True, broadcast_max_rows=1)
    topic_streams.await_queries(spark, topic_streams.start_topic_shared(src, "orders", settings), drain=True)
    assert seen == [(True, 40)]


def test_latest_inventory_moves_records(spark, tmp_path, monkeypatch):
    """And writes the rows that a comparison of whole silver rows gives."""
    base = {"event_type": "inventory_update", "ingestion_ts": "2026-05-02T12:00:04Z", "product_id": "K1", "sku": "s", "store_id": "a",
            "on_hand": 3, "available_to_promise": 2, "reorder_point": 5, "change_quantity": -1, "reason": "sale"}
    events = [base | {"event_id": f"e{i}", "event_ts": f"2026-05-02T12:0{i % 3}:00Z", "store_id": "ab"[i % 2], "on_hand": i} for i in range(8)]
    events += [base | {"event_id": "e7", "event_ts": "2026-05-02T12:01:00Z", "store_id": "b", "on_hand": None}, "{cut"]
    valid = silver.valid_rows(silver.silver_frame(envelope(spark, "inventory", events), "inventory", now=NOW))
    moved, newest = [], topic_streams.newest_rows
    monkeypatch.setattr(topic_streams, "newest_rows", lambda rows, keys=None: moved.append(rows.columns) or newest(rows, keys))
    topic_streams.LatestStateBatchWriter(f"{tmp_path}/log", now=NOW)(valid, 3)
    written = spark.read.parquet(f"{tmp_path}/log")
    assert "payload" in moved[0] and "on_hand" not in moved[0] and "_dq_errors" not in moved[0]
    assert written.columns == [*valid.columns, "_batch_id"] and written.count() == 2
    assert _rows(written.drop("_batch_id")) == _rows(newest(valid))


def test_redelivered_reads_the_events_once(spark):
    events = spark.createDataFrame([("7", 1), ("8", 2), (None, 3), ("x", 4), ("14", 5)], "order_id string, n int").where("n <> 4")
    twice = testviews.redelivered(events)
    assert twice.columns == events.columns
    assert sorted(r.n for r in twice.collect()) == [1, 1, 2, 3, 5, 5]
    assert twice._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_topics_of_the_lake_are_drained_in_turn(monkeypatch):
    from lakecart.plans import registry

    drained = []
    monkeypatch.setattr(registry, "_stream_base", lambda spark, name: ("base", "layout"))
    monkeypatch.setattr(registry, "_records", lambda spark, sf_dir, t: t)
    monkeypatch.setattr(registry, "_fx", lambda spark, sf_dir: {"orders": None})
    monkeypatch.setattr(testviews, "order_records", lambda orders: "faulty orders")
    monkeypatch.setattr(registry, "_drain", lambda spark, sf_dir, base, layout, published, **o: drained.append(published))
    assert registry._four_topics(None, "dir") == "layout"
    assert drained == [{"orders": "faulty orders"}, {"inventory": "inventory"}, {"pricing": "pricing"}, {"clickstream": "clickstream"}]
