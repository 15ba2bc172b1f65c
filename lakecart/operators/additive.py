"""Daily revenue whose distinct order counts add up over increments (A3).

An order id gets a number, dense within its day, from a growing dictionary; an increment stores the set of its orders
as exact bitmaps over those numbers.  OR-ing the stored bitmaps of any batches counts each order once, so day totals
come from the increments alone and no order is read again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakecart.functions.money import round_money
from lakecart.operators.gold import REVENUE_DAILY_KEY
from lakecart.sinks.layout import Layout
from lakecart.sinks.writers import replace_partitions
from lakecart.sources.tables import read_table_if_exists

# Numbers of one day are dealt in this many independent sequences, so a day with a third of all orders is not one task.
NUMBER_BUCKETS = 64
EXACT_MONEY = "decimal(28,6)"


def number_ids(ids: DataFrame, known: DataFrame | None, buckets: int = NUMBER_BUCKETS) -> DataFrame:
    """(order_date, order_id, order_no) of the ids that `known` lacks, numbered after it, from 1 within each day.

    `ids` holds distinct (order_date, order_id), no null id; a null date is a day of its own.  Sequence b of a day holds the
    numbers b + 1, b + 1 + buckets, …; within it ids go by their order, so the same call gives the same numbers.
    """
    bucket = F.pmod(F.xxhash64("order_id"), F.lit(buckets))
    new, top = ids, None
    if known is not None:
        k = known.select(F.col("order_date").alias("_date"), F.col("order_id").alias("_id"), "order_no")
        new = ids.join(k, ids.order_date.eqNullSafe(k["_date"]) & (ids.order_id == k["_id"]), "left_anti")
        top = known.groupBy(F.col("order_date").alias("_date"), F.pmod(F.col("order_no") - 1, F.lit(buckets)).alias("_b")) \
            .agg(F.max("order_no").alias("_top"))
    new = new.withColumn("_bucket", bucket)
    place = F.row_number().over(Window.partitionBy("order_date", "_bucket").orderBy("order_id"))
    new = new.withColumn("_place", place.cast("bigint"))
    first = F.col("_bucket") + 1 - buckets
    if top is not None:
        new = new.join(top, new.order_date.eqNullSafe(top["_date"]) & (new["_bucket"] == top["_b"]), "left")
        first = F.coalesce("_top", first)
    return new.select("order_date", "order_id", (first + F.col("_place") * buckets).alias("order_no"))


def increment(sales: DataFrame, numbers: DataFrame) -> DataFrame:
    """Sales (order_date, category, channel, order_id, quantity, order_total, gross_margin) → per group one row without a
    bucket, with the exact sums of units, revenue and margin, and one row per bitmap bucket: the orders as a bitmap cut
    behind its last bit.

    Rows without an order id, or with one that has no number, count in the sums and set no bit.  Sums need no number, so
    units and money are added up before any shuffle; a bitmap takes its full 4 KB until it is cut, so none is made before
    the shuffle: the bits of a bucket go there one by one.
    """
    n = numbers.select(F.col("order_date").alias("_date"), F.col("order_id").alias("_id"), "order_no")
    key = [*REVENUE_DAILY_KEY, "bucket"]
    bits = sales.select(*REVENUE_DAILY_KEY, "order_id") \
        .join(n, sales.order_date.eqNullSafe(n["_date"]) & (sales.order_id == n["_id"]), "inner") \
        .select(*REVENUE_DAILY_KEY, F.bitmap_bucket_number("order_no").alias("bucket"),
                F.bitmap_bit_position("order_no").alias("_bit"))
    bits = bits.repartition(*key).groupBy(*key).agg(F.bitmap_construct_agg("_bit").alias("_bits"), F.max("_bit").alias("_last")) \
        .select(*key, F.expr("substring(_bits, 1, cast(_last div 8 + 1 as int))").alias("bits"))
    # two tasks a core: the fewer, the more rows of a group meet before the shuffle
    sums = sales.coalesce(2 * sales.sparkSession.sparkContext.defaultParallelism).groupBy(*REVENUE_DAILY_KEY).agg(
        F.sum("quantity").alias("units_sold"), F.sum(F.col("order_total").cast(EXACT_MONEY)).alias("revenue"),
        F.sum(F.col("gross_margin").cast(EXACT_MONEY)).alias("gross_margin"))
    sums = sums.withColumn("bucket", F.lit(None).cast("bigint")).withColumn("bits", F.expr("X''"))
    return sums.select(*key, "bits", "units_sold", "revenue", "gross_margin").unionByName(bits, allowMissingColumns=True)


def additive_totals(increments: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Orders, units, revenue and margin per `by` (default day × category × channel) from stored increments alone.

    `by` must hold order_date: numbers identify an order within its day.  An empty table gives no rows.
    """
    by = by or REVENUE_DAILY_KEY
    if "order_date" not in by:
        raise ValueError("distinct orders add up within a day: group by order_date")
    sums = [F.sum(c).alias(c) for c in ("units_sold", "revenue", "gross_margin")]
    merged = increments.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), *sums)
    return merged.groupBy(*by).agg(
        F.sum(F.bitmap_count("bits")).alias("orders"), F.sum("units_sold").alias("units_sold"),
        round_money(F.sum("revenue").cast("double")).alias("revenue"),
        round_money(F.sum("gross_margin").cast("double")).alias("gross_margin"))


class AdditiveRevenueWriter:
    """Stores a micro-batch's increment and the numbers of its new orders.

    `gold/order_numbers` is partitioned by month and batch; a batch reads only the months between its first and last
    order date.  Batch ids must grow; a replayed batch sees only earlier ones, gives the same numbers and replaces its
    own partitions.  A batch's sales are persisted while they are written, so that its joins run once and not for each
    step; `hold=False` is for callers that persist the batch themselves.
    """

    def __init__(self, layout: Layout, buckets: int = NUMBER_BUCKETS, hold: bool = True):
        self.layout, self.buckets, self.hold = layout, buckets, hold
        self.numbers = layout.table("gold", "order_numbers")
        self.increments = layout.table("gold", "revenue_daily_additive")

    def _known(self, spark, before: int, span: tuple[date | None, date | None]) -> DataFrame | None:
        known = read_table_if_exists(spark, self.numbers, self.layout.fmt)
        if known is None:
            return None
        first, last = span
        month = F.col("order_month")
        near = month.isNull() if first is None else month.isNull() | month.between(first.replace(day=1), last.replace(day=1))
        return known.where((F.col("_batch_id") < before) & near)

    def __call__(self, enriched: DataFrame, batch_id: int) -> None:
        sales = enriched.select(F.to_date("event_ts").alias("order_date"), "category", "channel", "order_id", "quantity",
                                "order_total", "gross_margin")
        if not self.hold:
            return self._write(sales, int(batch_id))
        sales.persist()
        try:
            self._write(sales, int(batch_id))
        finally:
            sales.unpersist()

    def _write(self, sales: DataFrame, batch_id: int) -> None:
        spark, tag = sales.sparkSession, F.lit(batch_id).cast("bigint")
        span = tuple(sales.agg(F.min("order_date"), F.max("order_date")).first())
        ids = sales.where(F.col("order_id").isNotNull()).select("order_date", "order_id").distinct()
        new = number_ids(ids, self._known(spark, batch_id, span), self.buckets)
        new = new.withColumn("order_month", F.trunc("order_date", "month")).withColumn("_batch_id", tag)
        # a month's numbers in a few files, a busy month in several
        spread = F.pmod(F.xxhash64("order_id"), F.lit(4))
        replace_partitions(new.repartition("order_month", spread), self.numbers, ["order_month", "_batch_id"], self.layout.fmt)
        numbers = self._known(spark, batch_id + 1, span)
        numbers = numbers if numbers is not None else new
        replace_partitions(increment(sales, numbers).withColumn("_batch_id", tag), self.increments, ["_batch_id"],
                           self.layout.fmt)

    def totals(self, spark, by: list[str] | None = None) -> DataFrame:
        return additive_totals(spark.read.format(self.layout.fmt).load(self.increments), by)
