"""Driver tables → contract-shaped frames.

The driver supplies TPC-H-like tables; these builders map them onto the four
topics so every operator runs on data that grows with the tables:

* orders events: `lineitem ⋈ orders` (one event per line item)
* catalog: every `part`; a share of the orders names an unknown product, so the left join really misses
* inventory / pricing events: `lineitem ⋈ part`
* clickstream bus records: `events`, with deterministic corruption

The mappings are fixture definitions, not pipeline logic.  Every input row is kept:
the moduli below only decide which rows carry a deliberate fault (a message cut
short in transit, a missing field, an unparsable time) so the quality operators
have real failures to find; nothing is filtered, sampled or shortened to save work.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecart.functions.time import iso_utc_text
from lakecart.session import session_key

CLICK_PARTITIONS = 4

# Fixture corruption moduli on events.event_id (clickstream) and
# l_orderkey (orders payloads).
TRUNCATE_MOD, NULL_USER_MOD, BAD_TIME_MOD = 19, 17, 23
TRUNCATE_CHARS = 15
QTY_AS_TEXT_MOD, NO_PRICE_MOD, ORDER_BAD_TIME_MOD, USER_AS_NUMBER_MOD = 29, 31, 37, 41
# Also by l_orderkey: product unknown to the catalog; silver row flagged invalid; payload with an extra field,
# without sku, with the total 10.0; event delivered twice.
UNKNOWN_PRODUCT_MOD, INVALID_ROW_MOD, COUPON_MOD, NO_SKU_MOD, ROUND_TOTAL_MOD, TWICE_MOD = 43, 47, 53, 59, 61, 7


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  The read (and its schema-inference job) happens once per session
    and path; the tables are read-only inputs."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (session_key(spark), path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def orders_events(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Typed order events (silver field types: event_ts TIMESTAMP)."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    ts = F.col("o_orderdate").cast("timestamp")
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("event_id"),
        F.lit("order_created").alias("event_type"),
        ts.alias("event_ts"),
        ts.alias("ingestion_ts"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.concat(F.when(F.col("l_orderkey") % UNKNOWN_PRODUCT_MOD == 0, F.lit("X")).otherwise(F.lit("")),
                 F.col("l_partkey").cast("string")).alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        F.col("l_suppkey").cast("string").alias("store_id"),
        F.col("o_orderpriority").alias("channel"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("order_total"),
        F.lit("USD").alias("currency"),
        F.col("o_orderstatus").alias("status"),
    )


def catalog_text(part: DataFrame) -> DataFrame:
    """Catalog rows as the CSV would give them: every column text."""
    return part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("string").alias("base_price"),
        F.col("p_retailprice").cast("string").alias("cost"),
        F.col("p_size").cast("string").alias("reorder_point"),
    )


def catalog(part: DataFrame) -> DataFrame:
    """Typed catalog: product_id, product_name, category, brand, cost, catalog_reorder_point."""
    return part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("cost"),
        F.col("p_size").alias("catalog_reorder_point"),
    )


def inventory_events(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Typed inventory events, one per line item, stock levels from quantities."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    p = part.select("p_partkey", "p_size")
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    on_hand = F.col("l_quantity").cast("int")
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.lit("inventory_update").alias("event_type"),
        F.col("l_shipdate").cast("timestamp").alias("event_ts"),
        F.col("l_shipdate").cast("timestamp").alias("ingestion_ts"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        F.col("l_suppkey").cast("string").alias("store_id"),
        on_hand.alias("on_hand"),
        (on_hand - F.col("l_linenumber")).alias("available_to_promise"),
        F.col("p_size").alias("reorder_point"),
        (on_hand - F.lit(25)).alias("change_quantity"),
        F.lit("sale").alias("reason"),
    )


def pricing_events(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    p = part.select("p_partkey", "p_retailprice")
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.lit("price_change").alias("event_type"),
        F.col("l_shipdate").cast("timestamp").alias("event_ts"),
        F.col("l_shipdate").cast("timestamp").alias("ingestion_ts"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        F.col("p_retailprice").alias("old_price"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("new_price"),
        F.lit("USD").alias("currency"),
        F.lit("markdown").alias("reason"),
    )


def click_records(events: DataFrame) -> DataFrame:
    """Clickstream bus records (Kafka layout) from `events`, with corrupted payloads.

    event_id mod 19 = 0: payload cut to 15 characters; otherwise, independently,
    mod 17 = 0: user_id missing; mod 23 = 0: event_ts 'not-a-time'.
    """
    eid = F.col("event_id")
    iso = iso_utc_text(F.col("ts").cast("timestamp"))
    fields = F.struct(
        eid.cast("string").alias("event_id"),
        F.col("event_type").alias("event_type"),
        F.when(eid % BAD_TIME_MOD == 0, F.lit("not-a-time")).otherwise(iso).alias("event_ts"),
        iso.alias("ingestion_ts"),
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("session_id"),
        F.when(eid % NULL_USER_MOD != 0, F.concat(F.lit("U"), F.col("user_id").cast("string"))).alias("user_id"),
        F.concat(F.lit("P"), (eid % 50).cast("string")).alias("product_id"),
        F.concat(F.lit("p"), (eid % 5).cast("string")).alias("page"),
        F.concat(F.lit("d"), (eid % 4).cast("string")).alias("device"),
        F.lit("direct").alias("referrer"),
    )
    payload = F.to_json(fields)
    payload = F.when(eid % TRUNCATE_MOD == 0, F.substring(payload, 1, TRUNCATE_CHARS)).otherwise(payload)
    return events.select(
        F.concat(F.lit("S"), F.col("user_id").cast("string")).cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit("clickstream").alias("topic"),
        (eid % CLICK_PARTITIONS).cast("int").alias("partition"),
        eid.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def order_records(orders_ev: DataFrame, corrupt: bool = True) -> DataFrame:
    """Order bus records (Kafka layout) with JSON payloads of the order events.

    With `corrupt`, by order key: mod 29 = 0 quantity sent as text; mod 31 = 0
    unit_price missing; mod 37 = 0 event_ts 'not-a-time'; mod 41 = 0 user_id sent
    as a number; mod 53 = 0 a field beyond the contract; mod 59 = 0 no sku; mod 61 = 0
    order_total 10.0.  Key and offset come from the line item, partition from the order.
    """
    ok = F.col("order_id").cast("bigint")
    iso = iso_utc_text("event_ts")
    ev_ts = F.when(ok % ORDER_BAD_TIME_MOD == 0, F.lit("not-a-time")).otherwise(iso) if corrupt else iso
    price = F.when(ok % NO_PRICE_MOD != 0, F.col("unit_price")) if corrupt else F.col("unit_price")
    sku = F.when(ok % NO_SKU_MOD != 0, F.col("sku")) if corrupt else F.col("sku")
    total = F.when(ok % ROUND_TOTAL_MOD == 0, 10.0).otherwise(F.col("order_total")) if corrupt else F.col("order_total")
    extra = [F.when(ok % COUPON_MOD == 0, F.concat(F.lit("C"), "order_id")).alias("coupon")] if corrupt else []
    fields = F.struct(
        "event_id", "event_type", ev_ts.alias("event_ts"), iso_utc_text("ingestion_ts").alias("ingestion_ts"),
        "order_id", "user_id", "product_id", sku.alias("sku"), "store_id", "channel", "quantity",
        price.alias("unit_price"), total.alias("order_total"), "currency", "status", *extra,
    )
    payload = F.to_json(fields)
    if corrupt:
        payload = F.when(ok % QTY_AS_TEXT_MOD == 0,
                         F.regexp_replace(payload, r'"quantity":(-?[0-9]+)', '"quantity":"$1"')).otherwise(payload)
        payload = F.when(ok % USER_AS_NUMBER_MOD == 0,
                         F.regexp_replace(payload, r'"user_id":"([0-9]+)"', '"user_id":$1')).otherwise(payload)
    return orders_ev.select(
        F.col("event_id").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit("orders").alias("topic"),
        (ok % 3).cast("int").alias("partition"),
        F.xxhash64("event_id").alias("offset"),
        F.col("event_ts").alias("timestamp"),
    )


def flag_invalid(silver_rows: DataFrame, order_key: Column) -> DataFrame:
    """Silver rows with `_dq_is_valid`, false for every order key divisible by 47."""
    return silver_rows.withColumn("_dq_is_valid", order_key.cast("bigint") % INVALID_ROW_MOD != 0)


def redelivered(events: DataFrame) -> DataFrame:
    """The events, those of every order key divisible by 7 delivered twice, the copy exact."""
    copies = F.when(F.col("order_id").cast("bigint") % TWICE_MOD == 0, 2).otherwise(1)
    # one pass: a union would make the events twice
    return events.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


class Fixtures(Mapping):
    """Contract-shaped frames over one scale factor, each built on first use."""

    _BUILDERS = {
        "orders": (orders_events, ("lineitem", "orders")),
        "catalog": (catalog, ("part",)),
        "catalog_text": (catalog_text, ("part",)),
        "inventory": (inventory_events, ("lineitem", "part")),
        "pricing": (pricing_events, ("lineitem", "part")),
        "click_records": (click_records, ("events",)),
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._built = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            fn, tables = self._BUILDERS[name]
            self._built[name] = fn(*[table(self.spark, self.sf_dir, t) for t in tables])
        return self._built[name]

    def __iter__(self):
        return iter(self._BUILDERS)

    def __len__(self) -> int:
        return len(self._BUILDERS)


def load_fixtures(spark: SparkSession, sf_dir: str) -> Fixtures:
    return Fixtures(spark, sf_dir)
