"""Command line: `python -m lakecart <command> ...`.

  stream   bus/files/jsonl → bronze, silver, quarantine (+ gold increments for orders)
  refresh  silver → gold tables (batch)
  models   SQL models over the lakehouse + their column tests
  health   layer and checkpoint report
  publish  JSON-lines events → strict gate → bus records (Kafka or file bus)
"""

from __future__ import annotations

import argparse
import json
import sys

from lakecart.contracts import select_topics
from lakecart.operators.joins import DEFAULT_SALT_BUCKETS
from lakecart.plans.gold_refresh import DATE_SALT_BUCKETS
from lakecart.session import build_session
from lakecart.sinks.layout import Layout


def _layout(args) -> Layout:
    return Layout(root=args.lakehouse_root, checkpoint_root=args.checkpoint_root, fmt=args.format)


def _common(p: argparse.ArgumentParser) -> None:
    p.add_argument("--lakehouse-root", default="lakehouse")
    p.add_argument("--checkpoint-root", default="checkpoints")
    p.add_argument("--format", default="parquet", help="table format: parquet (default) or delta")
    p.add_argument("--master", default=None)


def cmd_stream(args) -> int:
    from lakecart.sources.catalog import load_catalog
    from lakecart.streaming.topic_streams import (DropListener, StreamSettings, await_queries, start_all,
                                                  topic_source, watermark_drops)

    spark = build_session(app="lakecart-stream", master=args.master)
    topics = select_topics(args.topics)
    catalog = load_catalog(spark, args.catalog) if "orders" in topics else None
    settings = StreamSettings(layout=_layout(args), available_now=args.available_now,
                              processing_time=args.processing_time, catalog=catalog,
                              shared_scan={"auto": None, "yes": True, "no": False}[args.shared_scan], collapse_copies=args.collapse_copies,
                              join_salt_buckets=args.join_salt_buckets)
    src = lambda t: topic_source(spark, t, args.source, args.location,
                                 starting_offsets=args.starting_offsets,
                                 max_files_per_trigger=args.max_files_per_trigger,
                                 max_offsets_per_trigger=args.max_offsets_per_trigger,
                                 min_partitions=args.min_partitions)
    drops = DropListener()
    spark.streams.addListener(drops)
    try:
        queries = start_all(spark, topics, src, settings)
        await_queries(spark, queries, drain=args.available_now)
        print(json.dumps({"rows_dropped_as_late": {q.name: watermark_drops(q, drops) for q in queries}}))
    finally:
        spark.streams.removeListener(drops)
    return 0


def cmd_refresh(args) -> int:
    from lakecart.plans.gold_refresh import refresh

    spark = build_session(app="lakecart-refresh", master=args.master)
    print(json.dumps(refresh(spark, _layout(args), args.partition_by_date, args.date_salt_buckets), indent=2))
    return 0


def cmd_models(args) -> int:
    from lakecart.plans.sql_models import build_models, test_models
    from lakecart.sources.catalog import load_catalog
    from lakecart.sources.tables import register_sources

    spark = build_session(app="lakecart-models", master=args.master)
    lay = _layout(args)
    register_sources(spark, lay)
    if args.catalog:
        load_catalog(spark, args.catalog).createOrReplaceTempView("product_catalog")
    build_models(spark, table_path=lambda n: lay.table("gold", f"model_{n}"), fmt=lay.fmt)
    rows = [r.asDict() for r in test_models(spark).collect()]     # one row per test: bounded
    print(json.dumps(rows, indent=2, default=str))
    return 1 if any(r["failures"] for r in rows) else 0


def cmd_health(args) -> int:
    from lakecart.operators.health import layer_contents, layer_health

    spark = build_session(app="lakecart-health", master=args.master)
    lay = _layout(args)
    layers = tuple(x.strip() for x in args.layers.split(",") if x.strip()) if args.layers else None
    out = layer_health(spark, lay, layers) if layers else layer_health(spark, lay)
    if args.contents:
        # the table list is one row per table: small and bounded
        names = [(r.layer, r.table) for r in out.filter("kind = 'table'").select("layer", "table").collect()]
        out = out.join(layer_contents(spark, lay, names), ["layer", "table"], "left")
    out = out.orderBy("kind", "layer", "table")
    out.write.mode("overwrite").json(args.output) if args.output else out.show(max(1, out.count()), truncate=False)
    return 0


def cmd_publish(args) -> int:
    from lakecart.operators.strict import publish_gate
    from lakecart.sinks.writers import publish_to_bus, publish_to_files
    from lakecart.sources.jsonl import jsonl_envelope

    spark = build_session(app="lakecart-publish", master=args.master)
    for topic in select_topics(args.topics):
        env = jsonl_envelope(spark, f"{args.input.rstrip('/')}/{topic}*.jsonl", topic)
        records = publish_gate(env, topic, num_partitions=args.partitions)
        if args.bus == "kafka":
            publish_to_bus(records, args.location)
        else:
            publish_to_files(records, f"{args.location.rstrip('/')}/{topic}")
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lakecart")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stream", help="run the streaming layers")
    _common(s)
    s.add_argument("--source", choices=["kafka", "files", "jsonl"], default="files")
    s.add_argument("--location", required=True, help="bootstrap servers, or the bus/JSONL folder")
    s.add_argument("--topics", default=None, help="comma-separated; default all")
    s.add_argument("--catalog", default=None, help="product catalog CSV (needed for orders)")
    s.add_argument("--available-now", action="store_true", help="drain what is there, then stop")
    s.add_argument("--processing-time", default=None, help="e.g. '30 seconds'")
    s.add_argument("--starting-offsets", default="earliest")
    s.add_argument("--max-files-per-trigger", type=int, default=None)
    s.add_argument("--max-offsets-per-trigger", type=int, default=None, help="Kafka: cap records per micro-batch")
    s.add_argument("--min-partitions", type=int, default=None, help="Kafka: split large bus partitions into tasks")
    s.add_argument("--join-salt-buckets", type=int, default=DEFAULT_SALT_BUCKETS,
                   help="salt the catalog join when the catalog is beyond the broadcast bound")
    s.add_argument("--collapse-copies", action="store_true",
                   help="collapse repeated events in each task before the dedupe shuffle")
    s.add_argument("--shared-scan", nargs="?", const="yes", default="auto", choices=["auto", "yes", "no"],
                   help="two queries per topic (bus read twice), tables partitioned by _batch_id; auto: for orders")
    s.set_defaults(func=cmd_stream)

    r = sub.add_parser("refresh", help="rebuild gold from silver")
    _common(r)
    r.add_argument("--partition-by-date", action="store_true")
    r.add_argument("--date-salt-buckets", type=int, default=DATE_SALT_BUCKETS,
                   help="tasks that write one order date (with --partition-by-date)")
    r.set_defaults(func=cmd_refresh)

    m = sub.add_parser("models", help="SQL models and their tests")
    _common(m)
    m.add_argument("--catalog", default=None)
    m.set_defaults(func=cmd_models)

    h = sub.add_parser("health", help="layer and checkpoint report")
    _common(h)
    h.add_argument("--output", default=None, help="write the report as JSON files here")
    h.add_argument("--contents", action="store_true", help="add rows and newest event time per table")
    h.add_argument("--layers", default=None, help="comma-separated subset of bronze,silver,quarantine,gold")
    h.set_defaults(func=cmd_health)

    pb = sub.add_parser("publish", help="gate JSON-lines events and publish them")
    pb.add_argument("--input", required=True, help="folder with <topic>*.jsonl files")
    pb.add_argument("--topics", default=None)
    pb.add_argument("--bus", choices=["kafka", "files"], default="files")
    pb.add_argument("--location", required=True)
    pb.add_argument("--partitions", type=int, default=None)
    pb.add_argument("--master", default=None)
    pb.set_defaults(func=cmd_publish)

    args = p.parse_args(argv)
    return args.func(args)


if __name__ == "__main__":
    sys.exit(main())
