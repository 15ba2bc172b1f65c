"""Tables whose schema grows, and the state behind streams."""

from __future__ import annotations

import tempfile
from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import order, records
from lakecart.operators.health import state_contents
from lakecart.sinks.evolving import SchemaConflict, append_evolving, merged_schema, read_evolving, recorded_schema
from lakecart.sinks.layout import Layout
from lakecart.sinks.writers import publish_to_files
from lakecart.streaming.topic_streams import StreamSettings, await_queries, start_topic, topic_source


def test_old_and_new_files_read_as_one_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_evolving(spark, path) is None and recorded_schema(spark, path) is None
    first = spark.createDataFrame([(1, 1.5, Decimal("1.25"), date(2026, 5, 1), (1,), [1])],
                                  "a int, f float, d decimal(5,2), t date, s struct<x:int>, l array<int>")
    append_evolving(first, path, 0)
    second = spark.createDataFrame([("new", 2**40, 2.25, Decimal("123456.789"), datetime(2026, 5, 2, 7), (2, "y"), [2**40])],
                                   "extra string, A bigint, f double, d decimal(12,3), t timestamp_ntz, s struct<x:bigint,y:string>, l array<bigint>")
    append_evolving(second, path, 1)
    append_evolving(first.select("a"), path, 2)  # fewer and narrower columns fit
    assert [f"{f.name}:{f.dataType.simpleString()}" for f in recorded_schema(spark, path).fields] == [
        "a:bigint", "f:double", "d:decimal(12,3)", "t:timestamp_ntz", "s:struct<x:bigint,y:string>", "l:array<bigint>", "extra:string"]
    rows = {r["a"]: r for r in read_evolving(spark, path).where("f is not null").collect()}
    assert rows[1]["d"] == Decimal("1.250") and rows[1]["t"] == datetime(2026, 5, 1) and rows[1]["extra"] is None
    assert rows[1]["s"]["x"] == 1 and rows[1]["s"]["y"] is None and rows[1]["l"] == [1] and rows[1]["f"] == 1.5
    assert rows[2**40]["extra"] == "new" and rows[2**40]["s"]["y"] == "y" and rows[2**40]["l"] == [2**40]
    assert read_evolving(spark, path).count() == 3
    append_evolving(first.select("a"), path, 2)  # a repeated commit replaces itself
    assert read_evolving(spark, path).count() == 3


@pytest.mark.parametrize("have, new", [("a int", "a string"), ("a bigint", "a double"), ("a string", "a int"), ("a boolean", "a int"),
                                       ("a struct<x:int>", "a struct<x:string>"), ("a array<int>", "a map<int,int>"),
                                       ("a decimal(38,0)", "a decimal(38,2)"), ("a timestamp", "a date")])
def test_conflicts_are_refused_before_writing(spark, tmp_path, have, new):
    path = str(tmp_path / "t")
    append_evolving(spark.createDataFrame([], have), path, 0)
    with pytest.raises(SchemaConflict):
        append_evolving(spark.createDataFrame([], new), path, 1)
    assert spark.read.parquet(f"{path}/schemas").count() == 1


def test_clashing_names_are_refused(spark, tmp_path):
    for ddl in ("a int, A int", "a int, _commit int"):
        with pytest.raises(SchemaConflict):
            append_evolving(spark.createDataFrame([], "x int").select(*[F.lit(1).alias(c.split()[0]) for c in ddl.split(", ")]),
                            str(tmp_path / "t"), 0)


def test_merge_keeps_the_table_order(spark):
    have, new = (spark.createDataFrame([], s).schema for s in ("a tinyint, b int", "c int, b smallint, a smallint"))
    assert [f"{f.name} {f.dataType.simpleString()}" for f in merged_schema(have, new).fields] == ["a smallint", "b int", "c int"]


def test_state_rows_follow_the_watermark(spark):
    base = tempfile.mkdtemp(prefix="lakecart-state-")
    layout = Layout.under(base)
    click = lambda i, hhmm: {"event_id": f"e{i}", "event_type": "view", "event_ts": f"2026-05-02T{hhmm}:00Z",
                             "ingestion_ts": "2026-05-02T12:00:00Z", "session_id": f"s{i}", "user_id": "u", "page": "p", "device": "d"}
    publish_to_files(records(spark, "clickstream", [click(1, "10:00"), click(2, "11:30"), click(3, "12:00"), order()]),
                     f"{base}/bus/clickstream")
    settings = StreamSettings(layout=layout, available_now=True, now=datetime(2026, 5, 2, 21, tzinfo=UTC))
    source = topic_source(spark, "clickstream", "files", f"{base}/bus")
    await_queries(spark, start_topic(source, "clickstream", settings), drain=True)
    rows = state_contents(spark, layout, [("silver", "clickstream"), ("bronze", "clickstream"), ("silver", "absent")]).collect()
    assert [(r.layer, r.table, r.operator, r.state_rows) for r in rows] == [("silver", "clickstream", "dedupe", 2)]
    assert state_contents(spark, layout, []).count() == 0
