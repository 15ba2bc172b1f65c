"""Named queries: every operator run end to end over the driver tables.

Each entry is `(spark, sf_dir) -> DataFrame`.  Timestamps leave as TIMESTAMP_NTZ
(UTC wall clock) and arrays as comma-joined text, so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecart.functions.fingerprint import fingerprint
from lakecart.operators import checks, gold, inventory, reports, silver, strict
from lakecart.session import configure, free_unreferenced
from lakecart.sources import bus, catalog as catalog_src, testviews

# Fixed fixture parameter: the "now" of the late-flag queries.
LATE_NOW = datetime(2024, 1, 15, 0, 0, tzinfo=UTC)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def portable(df: DataFrame) -> DataFrame:
    """Zoned timestamps → NTZ, arrays → comma-joined text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            cols.append(F.array_join(f.name, ",").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _fx(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    configure(spark)
    return testviews.load_fixtures(spark, sf_dir)


def _enriched(fx) -> DataFrame:
    return gold.enrich_orders(fx["orders"], fx["catalog"])


def _fact(fx) -> DataFrame:
    return gold.orders_fact(_enriched(fx))


def _top_products(fx) -> DataFrame:
    return gold.top_products_of(fx["orders"], fx["catalog"])


# ---- sources ---------------------------------------------------------------

@query
def catalog_scan(spark, sf_dir):
    return catalog_src.typed_catalog(_fx(spark, sf_dir)["catalog_text"])


def _catalog_csv(spark, sf_dir) -> str:
    from lakecart.session import run_dir

    path = f"{run_dir(spark, 'catalog')}/product_catalog"
    _fx(spark, sf_dir)["catalog_text"].write.option("header", True).csv(path)
    return path


@query
def catalog_csv_scan(spark, sf_dir):
    """The catalog written as CSV with a header and read back through the CSV source (S3)."""
    return catalog_src.load_catalog(spark, _catalog_csv(spark, sf_dir))


@query
def catalog_seed(spark, sf_dir):
    """The CSV catalog as the seed view `product_catalog`, queried with SQL."""
    catalog_src.load_catalog(spark, _catalog_csv(spark, sf_dir)).createOrReplaceTempView("product_catalog")
    return spark.sql("SELECT category, count(*) AS products, max(cost) AS max_cost, "
                     "sum(catalog_reorder_point) AS reorder_points FROM product_catalog GROUP BY category")


# Lines of one JSON-lines file, about 30 MB compressed.
JSONL_FILE_ROWS = 500_000


@query
def jsonl_orders(spark, sf_dir):
    """Order payloads written as JSON lines and read with the declared schema."""
    from lakecart.session import run_dir
    from lakecart.sources.jsonl import read_jsonl_events

    path = f"{run_dir(spark, 'jsonl')}/orders"
    records = testviews.order_records(_fx(spark, sf_dir)["orders"], corrupt=False)
    # a compressed file is read by one task, so none may grow with the table
    records.select(F.col("value").cast("string")).write.option("compression", "gzip") \
        .option("maxRecordsPerFile", JSONL_FILE_ROWS).text(path)
    return read_jsonl_events(spark, path, "orders")


@query
def bronze_envelope(spark, sf_dir):
    env = bus.envelope(_fx(spark, sf_dir)["click_records"], ingested_at=LATE_NOW)
    return portable(bus.bronze(env, "clickstream").drop("_ingested_at"))


# ---- silver ------------------------------------------------------------------

def _click_silver(spark, sf_dir):
    env = bus.envelope(_fx(spark, sf_dir)["click_records"], ingested_at=LATE_NOW)
    return silver.silver_frame(env, "clickstream", now=LATE_NOW)


_SILVER_OUT = ["event_id", "event_type", "event_ts", "ingestion_ts", "session_id", "user_id", "product_id",
               "sku", "page", "search_term", "device", "referrer", "kafka_offset", "kafka_partition"]


@query
def parse_clickstream(spark, sf_dir):
    env = bus.envelope(_fx(spark, sf_dir)["click_records"], ingested_at=LATE_NOW)
    return portable(silver.parse_topic(env, "clickstream").select(*_SILVER_OUT))


@query
def dq_errors(spark, sf_dir):
    return portable(_click_silver(spark, sf_dir).select("kafka_offset", "_dq_errors", "_dq_is_valid"))


@query
def silver_clickstream(spark, sf_dir):
    return portable(silver.valid_rows(_click_silver(spark, sf_dir)).select(*_SILVER_OUT, "_dq_is_late"))


@query
def quarantine_clickstream(spark, sf_dir):
    return portable(silver.quarantine_rows(_click_silver(spark, sf_dir))
                    .select("kafka_offset", "payload", "event_ts", "_dq_errors"))


@query
def late_flag(spark, sf_dir):
    return portable(_click_silver(spark, sf_dir).select("kafka_offset", "event_ts", "_dq_is_late"))


@query
def dedupe_orders(spark, sf_dir):
    return portable(silver.dedupe_events(_fx(spark, sf_dir)["orders"], "orders"))


# ---- gold --------------------------------------------------------------------

@query
def enrich_orders(spark, sf_dir):
    return portable(_enriched(_fx(spark, sf_dir)))


@query
def stg_orders(spark, sf_dir):
    """Staged orders; rows flagged invalid stay out."""
    return portable(gold.stage_orders(testviews.flag_invalid(_enriched(_fx(spark, sf_dir)), F.col("order_id"))))


@query
def orders_gold(spark, sf_dir):
    return portable(_fact(_fx(spark, sf_dir)))


@query
def revenue_daily(spark, sf_dir):
    return gold.revenue_daily(_fact(_fx(spark, sf_dir)))


@query
def top_products(spark, sf_dir):
    return _top_products(_fx(spark, sf_dir))


@query
def revenue_increment(spark, sf_dir):
    enriched = _enriched(_fx(spark, sf_dir))
    return gold.revenue_increment(enriched, F.col("order_id").cast("bigint") % 4)


@query
def orders_by_channel(spark, sf_dir):
    return reports.orders_by_channel(_fact(_fx(spark, sf_dir)))


@query
def revenue_trend(spark, sf_dir):
    return reports.revenue_trend(gold.revenue_daily(_fact(_fx(spark, sf_dir))))


@query
def top_products_table(spark, sf_dir):
    return reports.top_products_table(_top_products(_fx(spark, sf_dir)))


def _flagged_inventory(fx) -> DataFrame:
    return testviews.flag_invalid(fx["inventory"], F.split("event_id", "-")[0])


# ---- inventory -----------------------------------------------------------------

@query
def stg_inventory(spark, sf_dir):
    return portable(gold.stage_inventory(_flagged_inventory(_fx(spark, sf_dir))))


@query
def inventory_latest(spark, sf_dir):
    return portable(inventory.inventory_gold(_fx(spark, sf_dir)["inventory"]))


@query
def inventory_risk(spark, sf_dir):
    # ranked on the silver rows (they carry event_id for the tie-break), then the model's 8 columns
    return portable(inventory.inventory_risk_model(_fx(spark, sf_dir)["inventory"]))


@query
def inventory_alerts(spark, sf_dir):
    return portable(inventory.inventory_alerts(inventory.inventory_gold(_fx(spark, sf_dir)["inventory"])))


@query
def low_inventory_table(spark, sf_dir):
    alerts = inventory.inventory_alerts(inventory.inventory_gold(_fx(spark, sf_dir)["inventory"]))
    return reports.low_inventory_table(alerts)


@query
def stock_ledger(spark, sf_dir):
    inv = _fx(spark, sf_dir)["inventory"]
    led = inventory.stock_ledger(inv, delta="change_quantity", initial="reorder_point",
                                 bucket=30 * 86_400)
    return portable(led.select("event_id", "product_id", "store_id", "event_ts", "change_quantity",
                               "ledger_on_hand"))


# ---- data tests ------------------------------------------------------------------

@query
def check_not_null(spark, sf_dir):
    return portable(checks.failing_not_null(_fact(_fx(spark, sf_dir)), "category"))


@query
def check_non_negative(spark, sf_dir):
    return portable(checks.failing_non_negative(_fact(_fx(spark, sf_dir)), "gross_margin"))


@query
def check_accepted_values(spark, sf_dir):
    return checks.failing_accepted_values(_fact(_fx(spark, sf_dir)), "status", ["F", "O"])


@query
def data_tests(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    fact = _fact(fx)
    models = {
        "orders_gold": fact,
        "revenue_daily": gold.revenue_daily(fact),
        "top_products": _top_products(fx),
        "inventory_risk": inventory.inventory_risk_model(fx["inventory"]),
    }
    return checks.run_data_tests(models)


# ---- strict publish-side checks --------------------------------------------------

# Fixed fixture parameter: "now" for the payload late test on order events.
PAYLOAD_LATE_NOW = datetime(1998, 1, 1, 0, 0, tzinfo=UTC)


def _order_envelope(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return bus.envelope(testviews.order_records(fx["orders"]), ingested_at=LATE_NOW)


@query
def strict_type_errors(spark, sf_dir):
    checked = strict.check_events(_order_envelope(spark, sf_dir), "orders")
    return portable(checked.select("kafka_key", "_strict_errors", "_strict_is_valid"))


@query
def timestamp_errors(spark, sf_dir):
    return portable(strict.timestamp_errors(_order_envelope(spark, sf_dir), "orders")
                    .select("kafka_key", "_event_time", "_time_error"))


@query
def is_late(spark, sf_dir):
    return strict.late_by_payload(_order_envelope(spark, sf_dir), "orders", now=PAYLOAD_LATE_NOW) \
        .select("kafka_key", "_is_late")


@query
def event_fingerprint(spark, sf_dir):
    from lakecart.functions.time import iso_utc_text
    ev = _fx(spark, sf_dir)["orders"].select("event_id", "order_id", "product_id",
                                             iso_utc_text("event_ts").alias("event_ts"))
    return ev.select("event_id", fingerprint(ev, ["order_id", "product_id", "event_ts"]).alias("fingerprint"))


@query
def publish_gate(spark, sf_dir):
    """The published events whole: which fields, in which order, every value, and the total as it was written."""
    from lakecart.contracts import contract

    records = strict.publish_gate(_order_envelope(spark, sf_dir), "orders")
    schema = T.StructType([*contract("orders").schema.fields, T.StructField("coupon", T.StringType())])
    text = F.col("value").cast("string")
    read = records.select(F.col("key").cast("string").alias("kafka_key"), "topic",
                          F.col("timestamp").alias("kafka_timestamp"),
                          F.array_join(F.json_object_keys(text), ",").alias("fields"),
                          F.get_json_object(text, "$.order_total").alias("total_text"),
                          F.from_json(text, schema).alias("_v"))
    return portable(read.select("*", "_v.*").drop("_v"))


# ---- streaming: publish fixture records to a file bus, drain the topic's queries, read the sinks --------

def _records(spark, sf_dir, topic: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    if topic == "clickstream":
        return fx["click_records"]
    if topic == "orders":
        return testviews.order_records(fx["orders"], corrupt=False)
    return _published(fx[topic], topic)


def _stream_base(spark, name: str):
    from lakecart.session import run_dir
    from lakecart.sinks.layout import Layout

    base = run_dir(spark, f"stream-{name}")
    return base, Layout.under(base)


def _drain(spark, sf_dir, base, layout, published: dict[str, DataFrame], topics: str | None = None, **options):
    """Publish records to the file bus under `base`, start the topics' queries, drain them; returns the queries."""
    from lakecart.sinks.writers import publish_to_files
    from lakecart.streaming.topic_streams import StreamSettings, await_queries, start_all, topic_source

    free_unreferenced(spark)                          # earlier drains
    for topic, records in published.items():
        publish_to_files(records, f"{base}/bus/{topic}")
    settings = StreamSettings(layout=layout, available_now=True, now=LATE_NOW,
                              catalog=_fx(spark, sf_dir)["catalog"], **options)
    queries = start_all(spark, topics or ",".join(published),
                        lambda t: topic_source(spark, t, "files", f"{base}/bus", ingested_at=LATE_NOW), settings)
    await_queries(spark, queries, drain=True)
    return queries


def _drain_topic(spark, sf_dir, topic: str, **options):
    base, layout = _stream_base(spark, topic)
    _drain(spark, sf_dir, base, layout, {topic: _records(spark, sf_dir, topic)}, **options)
    return layout


@query
def stream_bronze(spark, sf_dir):
    lay = _drain_topic(spark, sf_dir, "clickstream")
    return portable(spark.read.parquet(lay.table("bronze", "clickstream")).drop("_ingested_at"))


@query
def stream_silver_clickstream(spark, sf_dir):
    """Dedupe keys only: which copy of a duplicate survives a streaming dedupe is arbitrary."""
    lay = _drain_topic(spark, sf_dir, "clickstream")
    return portable(spark.read.parquet(lay.table("silver", "clickstream"))
                    .select("session_id", "event_type", "event_ts"))


@query
def stream_quarantine(spark, sf_dir):
    lay = _drain_topic(spark, sf_dir, "clickstream")
    return portable(spark.read.parquet(lay.table("quarantine", "clickstream"))
                    .select("kafka_offset", "event_ts", "_dq_errors"))


@query
def stream_dedupe_orders(spark, sf_dir):
    """Order keys after the stream's watermark + dedupe (T1, T2); non-key columns of the
    surviving copy are arbitrary, so only the key leaves.  One query per table."""
    lay = _drain_topic(spark, sf_dir, "orders", shared_scan=False)
    return portable(spark.read.parquet(lay.table("silver", "orders")).select("order_id", "product_id", "event_ts"))


@query
def stream_shared_dedupe_orders(spark, sf_dir):
    """The same keys through the shared-scan mode (two queries per topic, foreachBatch writers)."""
    lay = _drain_topic(spark, sf_dir, "orders", shared_scan=True)
    return portable(spark.read.parquet(lay.table("silver", "orders")).select("order_id", "product_id", "event_ts"))


@query
def stream_collapsed_clickstream(spark, sf_dir):
    """Clickstream dedupe keys with repeated events collapsed map-side before the dedupe shuffle."""
    lay = _drain_topic(spark, sf_dir, "clickstream", collapse_copies=True)
    return portable(spark.read.parquet(lay.table("silver", "clickstream"))
                    .select("session_id", "event_type", "event_ts"))


@query
def stream_silver_inventory(spark, sf_dir):
    lay = _drain_topic(spark, sf_dir, "inventory")
    return portable(spark.read.parquet(lay.table("silver", "inventory")).select("product_id", "store_id", "event_ts"))


@query
def stream_silver_pricing(spark, sf_dir):
    lay = _drain_topic(spark, sf_dir, "pricing")
    return portable(spark.read.parquet(lay.table("silver", "pricing")).select("product_id", "event_ts"))


@query
def stream_topic_subset(spark, sf_dir):
    """Two of three published topics are selected (F6): only their bronze tables come to be."""
    from lakecart.sources.tables import read_table_if_exists

    base, layout = _stream_base(spark, "subset")
    topics = ["clickstream", "inventory", "pricing"]
    _drain(spark, sf_dir, base, layout, {t: _records(spark, sf_dir, t) for t in topics}, topics="clickstream,pricing")
    tables = [read_table_if_exists(spark, layout.table("bronze", t)) for t in topics]
    counts = [t.groupBy("topic").agg(F.count(F.lit(1)).alias("n_rows")) for t in tables if t is not None]
    out = counts[0]
    for c in counts[1:]:
        out = out.union(c)
    return out


# Fixed fixture parameter: the order date that parts the two drains of `stream_gold_increment`.
SECOND_DRAIN_FROM = datetime(1998, 1, 1, tzinfo=UTC)


@query
def stream_gold_increment(spark, sf_dir):
    """Gold increments of two drains of one checkpoint; repeated events are exact copies, so every column is fixed."""
    base, lay = _stream_base(spark, "gold")
    once = silver.dedupe_events(_fx(spark, sf_dir)["orders"], "orders")
    events, later = testviews.redelivered(once), F.col("event_ts") >= F.lit(SECOND_DRAIN_FROM)
    for part in (events.where(~later), events.where(later)):
        _drain(spark, sf_dir, base, lay, {"orders": testviews.order_records(part, corrupt=False)})
    return (spark.read.parquet(lay.table("gold", "revenue_daily_incremental"))
            .withColumn("first_drain", F.col("_batch_id") == 0).drop("_batch_id"))


@query
def stream_watermark_drops(spark, sf_dir):
    """Rows dropped as too late (T4): odd event ids arrive in a second drain, behind the first one's watermark."""
    from lakecart.streaming.topic_streams import DropListener, watermark_drops

    base, lay = _stream_base(spark, "drops")
    records, odd = _records(spark, sf_dir, "clickstream"), F.col("offset") % 2 == 1
    drops = DropListener()
    spark.streams.addListener(drops)
    try:
        for part in (records.where(~odd), records.where(odd)):
            queries = _drain(spark, sf_dir, base, lay, {"clickstream": part})
            dropped = max(watermark_drops(q, drops) for q in queries)
    finally:
        spark.streams.removeListener(drops)
    return (spark.read.parquet(lay.table("silver", "clickstream"))
            .agg(F.count(F.lit(1)).alias("silver_rows"), F.lit(dropped).cast("bigint").alias("rows_dropped")))


def _four_topics(spark, sf_dir):
    """A lakehouse drained from all four topics, order payloads with their faults."""
    from lakecart.contracts import select_topics

    base, layout = _stream_base(spark, "lake")
    published = {t: _records(spark, sf_dir, t) for t in select_topics(None)}
    published["orders"] = testviews.order_records(_fx(spark, sf_dir)["orders"])
    # one topic after the other: the shuffle files and the dedupe state of one are gone before the next one's come to be
    for topic, records in published.items():
        _drain(spark, sf_dir, base, layout, {topic: records})
    return layout


@query
def layer_health(spark, sf_dir):
    """Commits of each table and checkpoint of a lakehouse drained from all topics (paths, sizes and times vary)."""
    from lakecart.operators.health import layer_health as health

    out = health(spark, _four_topics(spark, sf_dir), checked_at=LATE_NOW)
    # batch writes are known by their job ids, which differ from run to run
    return portable(out.select("kind", "layer", "table", "commits", "checked_at",
                               F.regexp_extract("latest_commit", "^[0-9]+$", 0).alias("latest_batch")))


@query
def layer_contents(spark, sf_dir):
    """Rows and newest event time of each table of the same lakehouse."""
    from lakecart.operators.health import layer_contents as contents

    layout = _four_topics(spark, sf_dir)
    tables = [(layer, t) for layer in ("bronze", "silver") for t in ("orders", "inventory", "pricing", "clickstream")]
    tables += [("quarantine", "orders"), ("quarantine", "clickstream"), ("gold", "orders_gold_incremental"),
               ("gold", "revenue_daily_incremental")]
    return portable(contents(spark, layout, tables))


# ---- results carried over batches and runs: increments, late rows, ledger, latest state ------------------------

# Fixed fixture parameters: three micro-batches by supplier, so most orders span batches; one of them is replayed.
INCREMENT_BATCHES, REPLAYED_BATCH = 3, 1


@query
def additive_revenue_daily(spark, sf_dir):
    """Day totals from the stored increments of three batches alone (A3)."""
    from lakecart.operators.additive import AdditiveRevenueWriter

    _base, layout = _stream_base(spark, "additive")
    writer = AdditiveRevenueWriter(layout, hold=False)
    # all batches from one run of the joins
    sales = _enriched(_fx(spark, sf_dir)).select("event_ts", "category", "channel", "order_id", "quantity", "order_total",
                                                 "gross_margin", "store_id").persist()
    batch = F.col("store_id").cast("bigint") % INCREMENT_BATCHES
    try:
        for b in [*range(INCREMENT_BATCHES), REPLAYED_BATCH]:
            writer(sales.where(batch == b), b)
    finally:
        sales.unpersist()
    return writer.totals(spark)


@query
def stream_additive_revenue(spark, sf_dir):
    """Daily orders per category from the increments of two drains, bitmaps merged over channels."""
    from lakecart.operators.additive import AdditiveRevenueWriter

    base, lay = _stream_base(spark, "additive-stream")
    once = silver.dedupe_events(_fx(spark, sf_dir)["orders"], "orders")
    events, later = testviews.redelivered(once), F.col("event_ts") >= F.lit(SECOND_DRAIN_FROM)
    for part in (events.where(~later), events.where(later)):
        _drain(spark, sf_dir, base, lay, {"orders": testviews.order_records(part, corrupt=False)}, additive_revenue=True)
    return AdditiveRevenueWriter(lay).totals(spark, ["order_date", "category"])


@query
def stream_late_rows(spark, sf_dir):
    """Keys of silver and of the late table (T4): odd event ids arrive in a second drain, behind the first's watermark."""
    base, lay = _stream_base(spark, "late")
    records, odd = _records(spark, sf_dir, "clickstream"), F.col("offset") % 2 == 1
    for part in (records.where(~odd), records.where(odd)):
        _drain(spark, sf_dir, base, lay, {"clickstream": part}, keep_late=True)
    keys = ["session_id", "event_type", "event_ts"]
    parts = [spark.read.parquet(lay.table(layer, "clickstream")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
             .withColumn("layer", F.lit(layer)) for layer in ("silver", "late")]
    return portable(parts[0].union(parts[1]))


# Fixed fixture parameters: the ledger's second run starts here; every fifth order reaches the third run, late.
SECOND_RUN_FROM, LATE_ORDER_MOD = datetime(1996, 7, 1, tzinfo=UTC), 5


@query
def stock_ledger_continued(spark, sf_dir):
    """The stock ledger of three runs, the last with events for all earlier buckets."""
    from lakecart.operators.ledger_store import LedgerStore
    from lakecart.session import run_dir

    events = _fx(spark, sf_dir)["inventory"]
    store = LedgerStore(run_dir(spark, "ledger"), delta="change_quantity", initial="reorder_point", bucket=30 * 86_400)
    late = F.split("event_id", "-")[0].cast("bigint") % LATE_ORDER_MOD == 0
    first = F.col("event_ts") < F.lit(SECOND_RUN_FROM)
    for run, part in enumerate((events.where(~late & first), events.where(~late & ~first), events.where(late))):
        store.append(part, run)
    return portable(store.ledger(spark).select("event_id", "product_id", "store_id", "event_ts", "change_quantity",
                                               "ledger_on_hand"))


@query
def stream_inventory_latest(spark, sf_dir):
    """Latest state kept by a stream over three drains, the log folded after the second."""
    from lakecart.sinks.writers import publish_to_files
    from lakecart.streaming.topic_streams import (
        StreamSettings, await_queries, compact_latest_inventory, read_latest_inventory, start_latest_inventory, topic_source,
    )

    base, lay = _stream_base(spark, "latest")
    settings, records = StreamSettings(layout=lay, available_now=True, now=LATE_NOW), _records(spark, sf_dir, "inventory")
    for drain in range(3):
        free_unreferenced(spark)                      # earlier drains
        publish_to_files(records.where(F.pmod("offset", F.lit(3)) == drain), f"{base}/bus/inventory")
        source = topic_source(spark, "inventory", "files", f"{base}/bus", ingested_at=LATE_NOW)
        await_queries(spark, [start_latest_inventory(source, settings)], drain=True)
        if drain == 1:
            compact_latest_inventory(spark, lay)
    return portable(read_latest_inventory(spark, lay).select(
        "event_id", "event_type", "event_ts", "ingestion_ts", "product_id", "sku", "store_id", "on_hand",
        "available_to_promise", "reorder_point", "change_quantity", "reason", "is_low_inventory", "inventory_risk_level"))


# ---- SQL models over fixture silver views ---------------------------------------------

def _silver_tables(spark, sf_dir, topics=("orders", "inventory")):
    """Silver tables written from the fixtures, some rows flagged invalid."""
    from lakecart.sinks.writers import write_overwrite

    fx = _fx(spark, sf_dir)
    _base, layout = _stream_base(spark, "silver")
    if "orders" in topics:
        flagged = testviews.flag_invalid(_enriched(fx), F.col("order_id"))
        write_overwrite(flagged, layout.table("silver", "orders"))
    if "inventory" in topics:
        write_overwrite(_flagged_inventory(fx), layout.table("silver", "inventory"))
    return layout


def _register_silver_views(spark, sf_dir, topics=("orders", "inventory")):
    from lakecart.sources.tables import register_sources

    layout = _silver_tables(spark, sf_dir, topics)
    register_sources(spark, layout)
    return layout


@query
def sql_revenue_daily(spark, sf_dir):
    from lakecart.plans.sql_models import build_models
    _register_silver_views(spark, sf_dir, ["orders"])
    return build_models(spark, only=["stg_orders", "revenue_daily"])["revenue_daily"]


@query
def sql_inventory_risk(spark, sf_dir):
    from lakecart.plans.sql_models import build_models
    _register_silver_views(spark, sf_dir, ["inventory"])
    return portable(build_models(spark, only=["inventory_risk"])["inventory_risk"])


@query
def sql_model_tests(spark, sf_dir):
    from lakecart.plans.sql_models import build_models, test_models
    layout = _register_silver_views(spark, sf_dir)
    build_models(spark, table_path=lambda n: layout.table("gold", f"model_{n}"))
    return test_models(spark)


# ---- the other topics through the whole payload path ----------------------------------

def _published(events: DataFrame, topic: str) -> DataFrame:
    """Typed fixture events → bus records (canonical JSON, fingerprint key)."""
    from lakecart.contracts import contract
    from lakecart.functions.time import iso_utc_text
    from lakecart.sinks.writers import publish_frame

    c = contract(topic)
    wire = events.select(*[iso_utc_text(n).alias(n) if n in ("event_ts", "ingestion_ts") else F.col(n)
                           for n in c.field_names])
    return publish_frame(wire, topic, list(c.primary_key), c.field_names,
                         partition=F.lit(0), offset=F.xxhash64("event_id"), timestamp=F.lit(LATE_NOW))


def _published_envelope(events: DataFrame, topic: str) -> DataFrame:
    return bus.envelope(_published(events, topic), ingested_at=LATE_NOW)


_PRICING_OUT = ["event_id", "event_type", "event_ts", "product_id", "sku", "old_price", "new_price", "currency",
                "reason", "_dq_is_late"]
_INVENTORY_OUT = ["event_id", "event_ts", "product_id", "store_id", "on_hand", "available_to_promise",
                  "reorder_point", "change_quantity", "_dq_is_late"]


@query
def silver_pricing(spark, sf_dir):
    env = _published_envelope(_fx(spark, sf_dir)["pricing"], "pricing")
    sil = silver.dedupe_events(silver.valid_rows(silver.silver_frame(env, "pricing", now=PAYLOAD_LATE_NOW)), "pricing")
    return portable(sil.select(*_PRICING_OUT))


@query
def silver_inventory(spark, sf_dir):
    env = _published_envelope(_fx(spark, sf_dir)["inventory"], "inventory")
    sil = silver.dedupe_events(silver.valid_rows(silver.silver_frame(env, "inventory", now=PAYLOAD_LATE_NOW)),
                               "inventory")
    return portable(sil.select(*_INVENTORY_OUT))


@query
def revenue_daily_ordered(spark, sf_dir):
    """The daily revenue table in its report order (O1)."""
    return gold.order_revenue_daily(gold.revenue_daily(_fact(_fx(spark, sf_dir))))


# ---- the batch refresh job over silver tables written from the fixtures ----------------

def _refreshed(spark, sf_dir, topic: str):
    """The topic's half of the refresh; the other half has no silver table and is skipped."""
    from lakecart.plans.gold_refresh import refresh

    return refresh(spark, _silver_tables(spark, sf_dir, [topic]))


@query
def refresh_revenue_daily(spark, sf_dir):
    """Daily revenue as the refresh job writes it (silver → fact → written gold table, K3)."""
    return spark.read.parquet(_refreshed(spark, sf_dir, "orders")["revenue_daily"])


@query
def refresh_inventory_risk(spark, sf_dir):
    """The all-levels risk table as the refresh job writes it."""
    return portable(spark.read.parquet(_refreshed(spark, sf_dir, "inventory")["inventory_risk"]))


@query
def data_tests_observed(spark, sf_dir):
    """The gold model tests counted while the refresh job writes the models."""
    from lakecart.plans.gold_refresh import refresh

    tests = checks.ObservedTests()
    refresh(spark, _silver_tables(spark, sf_dir), tests=tests)
    return tests.results(spark)


@query
def refresh_changed_days(spark, sf_dir):
    """Daily revenue after a second refresh that reads only what changed: later days, and late orders of earlier ones."""
    from lakecart.plans.gold_refresh import refresh_changed
    from lakecart.sinks.writers import replace_partitions

    _base, layout = _stream_base(spark, "changed")
    silver_rows = testviews.flag_invalid(_enriched(_fx(spark, sf_dir)), F.col("order_id"))
    late = F.col("order_id").cast("bigint") % LATE_ORDER_MOD == 0
    batch = F.when(late, 2).when(F.col("event_ts") < F.lit(SECOND_DRAIN_FROM), 0).otherwise(1).cast("bigint")
    tagged = silver_rows.withColumn("_batch_id", batch)
    for arrived in (F.col("_batch_id") == 0, F.col("_batch_id") > 0):
        replace_partitions(tagged.where(arrived), layout.table("silver", "orders"), ["_batch_id"])
        tables = refresh_changed(spark, layout, period="month", date_salt_buckets=2)  # years of few orders a day
    return spark.read.parquet(tables["revenue_daily_by_period"]).drop("order_period")


@query
def stream_state_rows(spark, sf_dir):
    """Rows of dedupe state behind two drained topics (T8, D12): keys newer than the watermark are still held."""
    from lakecart.operators.health import state_contents

    base, layout = _stream_base(spark, "state")
    _drain(spark, sf_dir, base, layout, {t: _records(spark, sf_dir, t) for t in ("clickstream", "pricing")})
    found = state_contents(spark, layout, [("silver", "clickstream"), ("silver", "pricing"), ("bronze", "pricing"), ("silver", "none")])
    return found.select("layer", "table", "operator", "state_rows")


@query
def evolving_orders(spark, sf_dir):
    """The order fact appended in three commits whose schema grows: fewer and narrower columns first (K3, §1.3)."""
    from lakecart.session import run_dir
    from lakecart.sinks.evolving import append_evolving, read_evolving

    path, fact = run_dir(spark, "evolving"), _fact(_fx(spark, sf_dir))
    part = F.col("store_id").cast("bigint") % 3
    narrow = fact.withColumn("quantity", F.col("quantity").cast("smallint")).drop("gross_margin", "brand")
    append_evolving(narrow.where(part == 0), path, 0)
    append_evolving(fact.drop("gross_margin").where(part == 1), path, 1)
    append_evolving(fact.withColumn("quantity", F.col("quantity").cast("bigint")).where(part == 2), path, 2)
    return portable(read_evolving(spark, path))
