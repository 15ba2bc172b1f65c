import json

from helpers import order
from lakecart.sinks.layout import Layout
from lakecart.sources.jsonl import jsonl_envelope, read_jsonl_events
from lakecart.sources.tables import read_table_if_exists, register_sources
from lakecart.streaming.topic_streams import StreamSettings, await_queries, start_all, topic_source


def test_missing_table_is_none(spark, tmp_path):
    assert read_table_if_exists(spark, str(tmp_path / "nope")) is None
    spark.range(3).write.parquet(str(tmp_path / "yes"))
    assert read_table_if_exists(spark, str(tmp_path / "yes")).count() == 3
    lay = Layout.under(str(tmp_path / "lake"))
    assert register_sources(spark, lay) == []


def test_jsonl_typed_and_raw(spark, tmp_path):
    p = tmp_path / "orders.jsonl"
    p.write_text(json.dumps(order()) + "\n" + json.dumps(order(quantity="x")) + "\nnot json\n")
    typed = read_jsonl_events(spark, str(p), "orders")
    assert typed.count() == 3 and typed.first().order_id == order()["order_id"]
    env = jsonl_envelope(spark, str(p), "orders")
    assert env.columns == ["kafka_key", "payload", "kafka_topic", "kafka_partition", "kafka_offset",
                           "kafka_timestamp", "_ingested_at"]
    assert env.filter("payload = 'not json'").count() == 1


def test_jsonl_stream_with_topic_selection(spark, tmp_path):
    for topic, rows in (("clickstream", [{"event_id": "c1", "event_type": "view", "event_ts": "2026-05-02T10:00:00Z",
                                          "session_id": "S1", "user_id": "U1", "page": "home", "device": "ios"},
                                         {"event_id": "c2", "event_type": "view"}]),
                        ("pricing", [{"event_id": "p1", "event_type": "price_change",
                                      "event_ts": "2026-05-02T10:00:00Z", "product_id": "P1",
                                      "old_price": 1, "new_price": 2.5}])):
        d = tmp_path / "in" / topic
        d.mkdir(parents=True)
        (d / "part-0.jsonl").write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    lay = Layout.under(str(tmp_path / "out"))
    settings = StreamSettings(layout=lay, available_now=True)
    qs = start_all(spark, "clickstream, pricing", lambda t: topic_source(spark, t, "jsonl", str(tmp_path / "in")),
                   settings)
    assert len(qs) == 6                                 # 3 tables × 2 topics, no gold for these topics
    await_queries(spark, qs, drain=True)
    assert [r.event_id for r in spark.read.parquet(lay.table("silver", "clickstream")).collect()] == ["c1"]
    q = spark.read.parquet(lay.table("quarantine", "clickstream")).first()
    assert q.event_id == "c2" and "session_id:null" in q._dq_errors
    p = spark.read.parquet(lay.table("silver", "pricing")).first()
    assert (p.old_price, p.new_price) == (1.0, 2.5)
