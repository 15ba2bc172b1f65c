"""Per-topic streaming fan-out: bus → bronze, silver, quarantine, and gold increments for orders.

T1–T9, K1, K2, F6.  Each topic gets its own queries with their own checkpoints,
so a failing topic does not stop the others and every query resumes exactly
where it stopped.  The bus source (Kafka) and its file twin produce the same
envelope, so everything below the source is one code path.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from lakecart.contracts import contract, select_topics
from lakecart.operators import gold, inventory, silver
from lakecart.operators.additive import AdditiveRevenueWriter
from lakecart.operators.inventory import with_risk
from lakecart.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, DEFAULT_SALT_BUCKETS
from lakecart.session import FREE_SHUFFLES, session_settings
from lakecart.sinks.layout import Layout
from lakecart.sinks.writers import free_micro_batch, replace_batch, replace_partitions, write_stream
from lakecart.sources import bus, jsonl
from lakecart.sources.tables import read_table_if_exists


@dataclass
class StreamSettings:
    layout: Layout
    available_now: bool = False
    processing_time: str | None = None
    now: datetime | str | Column | None = None          # None: wall clock per micro-batch
    catalog: DataFrame | None = None                     # typed catalog for order enrichment
    broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS
    # salt the catalog join when the catalog is too big to broadcast (skew-join splitting does not run in streams)
    join_salt_buckets: int | None = DEFAULT_SALT_BUCKETS
    with_gold: bool = True
    # two queries per topic instead of one per table (see start_topic_shared); None: for orders, whose silver and
    # gold tables then come from one dedupe and hold the same copy of a repeated event
    shared_scan: bool | None = None
    collapse_copies: bool = False  # collapse repeated events map-side before the dedupe shuffle
    # one query per topic that writes the rows behind the watermark to a `late` table (see KeepLateBatchWriter)
    keep_late: bool = False
    additive_revenue: bool = False  # orders: also daily increments whose distinct order counts add up
    query_prefix: str = ""


def topic_source(spark: SparkSession, topic: str, kind: str, location: str,
                 starting_offsets: str = "earliest", max_files_per_trigger: int | None = None,
                 ingested_at=None, max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    """Envelope stream for a topic.  `kind`: 'kafka' (location = bootstrap servers),
    'files' (bus records as parquet under location/topic) or 'jsonl' (lines under location/topic)."""
    contract(topic)
    if kind == "kafka":
        records = bus.bus_stream(spark, location, topic, starting_offsets=starting_offsets,
                                 max_offsets_per_trigger=max_offsets_per_trigger, min_partitions=min_partitions)
        return bus.envelope(records, ingested_at)
    if kind == "files":
        records = bus.file_bus_stream(spark, f"{location.rstrip('/')}/{topic}", max_files_per_trigger)
        return bus.envelope(records, ingested_at)
    if kind == "jsonl":
        return jsonl.jsonl_envelope(spark, f"{location.rstrip('/')}/{topic}", topic, stream=True,
                                    ingested_at=ingested_at, max_files_per_trigger=max_files_per_trigger)
    raise ValueError(f"unknown source kind {kind!r}")


class OrderGoldBatchWriter:
    """`foreachBatch` writer for order gold increments (K2, A3).

    Writes the 15-column order fact and, from the fact as written, the product-grain revenue increment, both
    partitioned by `_batch_id` with dynamic partition overwrite: a micro-batch
    replayed after a failure replaces its own partition instead of appending a
    second copy.  An empty batch writes no rows.  `free`: batches come from a stream, and their shuffle files go once
    the fact is written.
    """

    def __init__(self, layout: Layout, additive: bool = False, free: bool = False):
        self.layout, self.free = layout, free
        self.additive = AdditiveRevenueWriter(layout, hold=False) if additive else None

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        lay = self.layout
        fact = replace_batch(gold.orders_fact(batch_df), lay.table("gold", "orders_gold_incremental"), batch_id, lay.fmt)
        if fact is None:
            return
        if self.free:
            free_micro_batch(batch_df)
        if self.additive:
            self.additive(fact, batch_id)
        inc = gold.revenue_increment(fact, batch_id)
        replace_partitions(inc, lay.table("gold", "revenue_daily_incremental"), ["_batch_id"], lay.fmt)


class RawBatchWriter:
    """Shared-scan, stateless half: one micro-batch → bronze rows, and from these, as written, quarantine rows.

    The bus is read once without holding a copy of the micro-batch in memory or on local disks.
    """

    def __init__(self, topic: str, settings: StreamSettings):
        self.topic, self.settings = topic, settings

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        lay, bid = self.settings.layout, F.lit(int(batch_id)).cast("bigint")
        if batch_df.isEmpty():
            return
        path = lay.table("bronze", self.topic)
        replace_partitions(bus.bronze(batch_df, self.topic).withColumn("_batch_id", bid), path, ["_batch_id"], lay.fmt)
        written = batch_df.sparkSession.read.format(lay.fmt).load(path).where(F.col("_batch_id") == bid)
        bad = silver.quarantine_rows(silver.silver_frame(written.select(*batch_df.columns), self.topic, now=self.settings.now))
        replace_partitions(bad.withColumn("_batch_id", bid), lay.table("quarantine", self.topic),
                           ["_batch_id"], lay.fmt)


class CleanBatchWriter:
    """Shared-scan, stateful half: one deduped micro-batch → silver, and for orders the gold increments of the rows as written.

    `free`: batches come from a stream, and their shuffle files go once silver is written.
    """

    def __init__(self, topic: str, settings: StreamSettings, free: bool = False):
        self.topic, self.settings, self.free = topic, settings, free

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        lay = self.settings.layout
        written = replace_batch(batch_df, lay.table("silver", self.topic), batch_id, lay.fmt)
        if written is not None and self.topic == "orders" and self.settings.with_gold:
            if self.free:
                free_micro_batch(batch_df)
            OrderGoldBatchWriter(lay, self.settings.additive_revenue)(written, batch_id)


class KeepLateBatchWriter:
    """One stateless query per topic: bronze, quarantine, late and silver rows (and gold for orders) of each micro-batch.

    The watermark in force in a batch is the newest valid event time of all earlier batches, carried in the small table
    `late/<topic>_watermarks` (one row a batch), less the topic's delay.  Valid rows at or behind it go to `late/<topic>`;
    the others are deduplicated on the contract key (a fixed copy stays) and against silver rows newer than the
    watermark, which are all they can repeat, so every valid row is a silver row, a copy of one, or late.  A replayed batch
    sees only earlier batches and replaces its own partitions.
    """

    def __init__(self, topic: str, settings: StreamSettings):
        self.topic, self.settings = topic, settings

    def watermark(self, spark: SparkSession, batch_id: int) -> Column:
        """The watermark in force in a batch as a literal; null before the first valid row."""
        marks = read_table_if_exists(spark, self.settings.layout.table("late", f"{self.topic}_watermarks"))
        newest = None
        if marks is not None:
            newest = marks.where(F.col("_batch_id") < batch_id).agg(F.max(F.unix_micros("newest"))).first()[0]
        delay = F.expr(f"INTERVAL {contract(self.topic).watermark_delay}")
        return F.timestamp_micros(F.lit(newest).cast("bigint")) - delay

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        lay, c, spark, number = self.settings.layout, contract(self.topic), batch_df.sparkSession, int(batch_id)
        RawBatchWriter(self.topic, self.settings)(batch_df, batch_id)
        valid = silver.valid_rows(silver.silver_frame(batch_df, self.topic, now=self.settings.now)).persist()
        try:
            if valid.isEmpty():
                return
            tag, mark, time = F.lit(number).cast("bigint"), self.watermark(spark, number), F.col(c.event_time)
            is_late = F.coalesce(time <= mark, F.lit(False))
            replace_partitions(valid.where(is_late).withColumn("_batch_id", tag), lay.table("late", self.topic),
                               ["_batch_id"], lay.fmt)
            fresh = silver.dedupe_events(valid.where(~is_late), self.topic)
            held = read_table_if_exists(spark, lay.table("silver", self.topic), lay.fmt)
            if held is not None:
                held = held.where((F.col("_batch_id") < number) & F.coalesce(time > mark, F.lit(True)))
                held = held.select(*[F.col(k).alias(f"_held_{k}") for k in c.dedupe_key])
                same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in c.dedupe_key]
                fresh = fresh.join(held, same, "left_anti")
            if self.topic == "orders":
                fresh = gold.enrich_orders(fresh, self.settings.catalog, self.settings.broadcast_max_rows,
                                           self.settings.join_salt_buckets)
            CleanBatchWriter(self.topic, self.settings)(fresh, batch_id)
            newest = valid.agg(F.max(c.event_time).alias("newest")).withColumn("_batch_id", tag)
            replace_partitions(newest, lay.table("late", f"{self.topic}_watermarks"), ["_batch_id"], "parquet")
        finally:
            valid.unpersist()


class LatestStateBatchWriter:
    """Upsert log of the latest row per key: a micro-batch's keys, each with its newest row, are its own partition.

    Silver rows of inventory are moved as `silver.records_behind` (here with the event id) and parsed again with `now`.
    """

    def __init__(self, path: str, fmt: str = "parquet", now: datetime | str | Column | None = None):
        self.path, self.fmt, self.now = path, fmt, now

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        moved = newest_rows(silver.records_behind(batch_df, "inventory", ["event_id"]))
        rows = silver.parsed_again(moved.drop("event_id"), "inventory", self.now)
        replace_partitions(rows.withColumn("_batch_id", F.lit(int(batch_id)).cast("bigint")), self.path, ["_batch_id"], self.fmt)


# What tells the newer of two rows of a key, and at last, of rows equal in these, the payload: it holds all other fields.
NEWEST = ["event_ts", "event_id", "kafka_partition", "kafka_offset", "payload"]


def newest_rows(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The newest row of each key (`inventory.latest_state`'s order, nulls last).  A partial top-1 runs before the shuffle."""
    return inventory.latest_state(rows, keys, tie_break=NEWEST[1:])


def latest_inventory_stream(envelope_df: DataFrame, settings: StreamSettings) -> DataFrame:
    """Valid inventory rows (W1).  The newest row of all batches is the newest of the batches' newest rows, so the stream
    holds no state: the log is all there is to keep."""
    return silver.valid_rows(silver.silver_frame(envelope_df, "inventory", now=settings.now))


def start_latest_inventory(envelope_df: DataFrame, settings: StreamSettings) -> StreamingQuery:
    """Keep the upsert log `gold/inventory_latest_log` up to date; read it with `read_latest_inventory`."""
    lay = settings.layout
    writer = LatestStateBatchWriter(lay.table("gold", "inventory_latest_log"), lay.fmt, settings.now)
    return _start_batch_query(latest_inventory_stream(envelope_df, settings), writer, lay.checkpoint("gold", "inventory_latest"),
                              f"{settings.query_prefix}inventory_latest", settings)


def read_latest_inventory(spark: SparkSession, layout: Layout) -> DataFrame:
    """The latest state with its risk columns, as `inventory.inventory_gold` of all drained events."""
    base, log = (read_table_if_exists(spark, layout.table("gold", n), layout.fmt)
                 for n in ("inventory_latest_base", "inventory_latest_log"))
    if base is not None:
        through = base.agg(F.max("_through")).first()[0]
        base = base.where(F.col("_through") == through).drop("_through")
        log = base.unionByName(log.where(F.col("_batch_id") > through))
    return with_risk(newest_rows(log).drop("_batch_id"))


def compact_latest_inventory(spark: SparkSession, layout: Layout) -> None:
    """Fold the log into a base table; readers then skip the folded batches.  Nothing is deleted; repeating it is safe."""
    base, log = (read_table_if_exists(spark, layout.table("gold", n), layout.fmt)
                 for n in ("inventory_latest_base", "inventory_latest_log"))
    if log is None or log.isEmpty():
        return
    through = log.agg(F.max("_batch_id")).first()[0]
    rows = log.where(F.col("_batch_id") <= through)
    folded = None if base is None else base.agg(F.max("_through")).first()[0]
    if folded is not None:
        if folded >= through:
            return
        rows = base.where(F.col("_through") == folded).drop("_through").unionByName(rows.where(F.col("_batch_id") > folded))
    replace_partitions(newest_rows(rows).withColumn("_through", F.lit(through)), layout.table("gold", "inventory_latest_base"),
                       ["_through"], layout.fmt)


def _deduped(rows: DataFrame, topic: str, settings: StreamSettings) -> DataFrame:
    return silver.stream_dedupe(silver.collapse_copies(rows, topic) if settings.collapse_copies else rows, topic)


def _catalog_join(settings: StreamSettings) -> tuple:
    if settings.catalog is None:
        raise ValueError("orders need a catalog for enrichment")
    return settings.catalog, settings.broadcast_max_rows, settings.join_salt_buckets


def topic_frames(envelope_df: DataFrame, topic: str, settings: StreamSettings) -> dict[str, DataFrame]:
    """The plans of one topic: bronze, silver (valid, watermarked, deduped, enriched) and quarantine."""
    parsed = silver.silver_frame(envelope_df, topic, now=settings.now)
    # the dedupe shuffles payloads, not payloads and their fields; parsing twice costs less than moving both
    records, extra = _deduped(silver.records_behind(silver.valid_rows(parsed), topic), topic, settings), []
    if topic == "orders":                             # and so does the join with a catalog beyond the broadcast bound
        records, extra = gold.with_dimensions(records, *_catalog_join(settings)), gold.DIMENSION_COLUMNS
    valid = silver.parsed_again(records, topic, settings.now, carry=extra)
    if topic == "orders":
        first = [n for n in valid.columns if n not in ("product_id", *extra)]
        valid = gold.with_margin(valid.select("product_id", *first, *extra))
    return {"bronze": bus.bronze(envelope_df, topic), "silver": valid, "quarantine": silver.quarantine_rows(parsed)}


def sold_orders(envelope_df: DataFrame, settings: StreamSettings) -> DataFrame:
    """The deduped, enriched orders of a query that writes gold alone: what the fact is made of, no payload is moved."""
    valid = silver.valid_rows(silver.silver_frame(envelope_df, "orders", now=settings.now))
    sold = valid.select(*[n for n in gold.ORDER_FACT_COLUMNS if n in valid.columns])
    return gold.enrich_orders(_deduped(sold, "orders", settings), *_catalog_join(settings))


def _start_batch_query(df: DataFrame, writer, checkpoint: str, name: str,
                       settings: StreamSettings, mode: str = "append") -> StreamingQuery:
    w = df.writeStream.foreachBatch(writer).outputMode(mode).option("checkpointLocation", checkpoint) \
        .queryName(name)
    if settings.available_now:
        w = w.trigger(availableNow=True)
    elif settings.processing_time:
        w = w.trigger(processingTime=settings.processing_time)
    with session_settings(df.sparkSession, FREE_SHUFFLES):
        return w.start()


def _all_or_none(starters: list) -> list[StreamingQuery]:
    """Start each query in turn; if one cannot start, stop those already running and re-raise."""
    started: list[StreamingQuery] = []
    try:
        for start in starters:
            started.append(start())
    except BaseException:
        for q in started:
            q.stop()
        raise
    return started


def start_topic_shared(envelope_df: DataFrame, topic: str, settings: StreamSettings) -> list[StreamingQuery]:
    """Two queries per topic instead of three or four: the bus is read twice, not once per table,
    and order dedupe state is held once.  Tables gain a `_batch_id` partition column; each
    micro-batch replaces its own partition, so replays leave one copy."""
    lay = settings.layout
    frames = topic_frames(envelope_df, topic, settings)
    name = f"{settings.query_prefix}{topic}"
    return _all_or_none([
        lambda: _start_batch_query(envelope_df, RawBatchWriter(topic, settings), lay.checkpoint("bronze", topic),
                                   f"{name}_raw", settings),
        lambda: _start_batch_query(frames["silver"], CleanBatchWriter(topic, settings, free=True),
                                   lay.checkpoint("silver", topic), f"{name}_clean", settings),
    ])


def start_topic(envelope_df: DataFrame, topic: str, settings: StreamSettings) -> list[StreamingQuery]:
    """Start the topic's queries: bronze, silver, quarantine, plus gold increments for orders."""
    if settings.keep_late:
        if topic == "orders" and settings.catalog is None:
            raise ValueError("orders need a catalog for enrichment")
        return [_start_batch_query(envelope_df, KeepLateBatchWriter(topic, settings), settings.layout.checkpoint("silver", topic),
                                   f"{settings.query_prefix}{topic}_keep_late", settings)]
    if topic == "orders" if settings.shared_scan is None else settings.shared_scan:
        return start_topic_shared(envelope_df, topic, settings)
    lay = settings.layout
    frames = topic_frames(envelope_df, topic, settings)
    name = f"{settings.query_prefix}{topic}"

    def sink(layer):
        return lambda: write_stream(frames[layer], lay.table(layer, topic), lay.checkpoint(layer, topic),
                                    available_now=settings.available_now, fmt=lay.fmt,
                                    query_name=f"{name}_{layer}", processing_time=settings.processing_time)

    starters = [sink(layer) for layer in ("bronze", "silver", "quarantine")]
    if topic == "orders" and settings.with_gold:
        starters.append(lambda: _start_batch_query(sold_orders(envelope_df, settings), OrderGoldBatchWriter(lay, settings.additive_revenue, free=True),
                                                   lay.checkpoint("gold", topic), f"{name}_gold", settings))
    return _all_or_none(starters)


def start_all(spark: SparkSession, topics: str | list[str] | None,
              source: Callable[[str], DataFrame], settings: StreamSettings) -> list[StreamingQuery]:
    """Start every selected topic (F6); `source(topic)` returns that topic's envelope stream.
    All or none: if a topic cannot start, the queries already started are stopped."""
    names = select_topics(topics) if not isinstance(topics, list) else [contract(t).topic for t in topics]
    queries: list[StreamingQuery] = []
    try:
        for t in names:
            queries.extend(start_topic(source(t), t, settings))
    except BaseException:
        for q in queries:
            q.stop()
        raise
    return queries


def await_queries(spark: SparkSession, queries: list[StreamingQuery], drain: bool) -> None:
    """Drain mode waits for every query; continuous mode returns when any query ends.

    A failed query stops its siblings (no half-running topic fan-out is left behind)
    and its error is raised; the checkpoints let a rerun resume where each stopped.
    """
    try:
        if drain:
            for q in queries:
                q.awaitTermination()
                if q.exception() is not None:
                    raise q.exception()
        else:
            spark.streams.awaitAnyTermination()
            failed = [q for q in queries if not q.isActive and q.exception() is not None]
            if failed:
                raise failed[0].exception()
    except BaseException:
        for q in queries:
            if q.isActive:
                q.stop()
        raise


class DropListener(StreamingQueryListener):
    """Rows dropped as too late, per query and micro-batch, from every progress event since it was added with
    `spark.streams.addListener` (T4 metric).  Only batches that dropped rows leave an entry."""

    def __init__(self):
        self._drops: dict[tuple[str, int], int] = {}

    def record(self, query_id: str, batch_id: int, dropped: int) -> None:
        if dropped:
            key = (str(query_id), int(batch_id))
            self._drops[key] = max(dropped, self._drops.get(key, 0))

    def total(self, query_id: str) -> int:
        return sum(n for (q, _), n in list(self._drops.items()) if q == str(query_id))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.record(p.id, p.batchId, sum(op.numRowsDroppedByWatermark for op in p.stateOperators))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def watermark_drops(query: StreamingQuery, listener: DropListener | None = None) -> int:
    """Rows dropped as too late by the query's stateful operators (T4).

    With a listener, all it has seen since it was added plus the progress the query still holds (events arrive a
    little late); without one, only the latter (`spark.sql.streaming.numRecentProgressUpdates`, 100 by default).
    """
    counts = listener or DropListener()
    for p in query.recentProgress:
        counts.record(p["id"], p["batchId"], sum(int(op["numRowsDroppedByWatermark"]) for op in p["stateOperators"]))
    return counts.total(query.id)
