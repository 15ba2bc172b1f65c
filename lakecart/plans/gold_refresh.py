"""Batch rebuild of the gold tables from silver (the refresh job).

The order fact is written first and the aggregates read it back, so the silver
scan and catalog join happen once (the written table cuts the lineage), and the
aggregates read only the columns they need.  A missing silver table skips its half.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecart.operators import gold, inventory
from lakecart.operators.checks import ObservedTests
from lakecart.sinks.layout import Layout
from lakecart.sinks.writers import replace_partitions, write_overwrite
from lakecart.sources.tables import read_table_if_exists

DATE_SALT_BUCKETS = 16


def _by_date(df: DataFrame, salt_buckets: int = DATE_SALT_BUCKETS) -> DataFrame:
    """Cluster rows by order date for a date-partitioned write; a deterministic salt
    spreads one busy date over several tasks instead of one."""
    salt = F.pmod(F.xxhash64("order_id", "product_id", "event_ts"), F.lit(salt_buckets))
    return df.repartition("order_date", salt)


def rebuild_orders_gold(spark: SparkSession, silver_orders: DataFrame, layout: Layout,
                        partition_by_date: bool = False, date_salt_buckets: int = DATE_SALT_BUCKETS,
                        tests: ObservedTests | None = None) -> dict[str, str]:
    watch = tests.watch if tests else lambda _, df: df
    fact = gold.orders_fact(gold.stage_orders(silver_orders))
    path = layout.table("gold", "orders_gold")
    fact = watch("orders_gold", fact)
    if partition_by_date:
        write_overwrite(_by_date(fact, date_salt_buckets), path, layout.fmt, partition_by=["order_date"])
    else:
        write_overwrite(fact, path, layout.fmt)
    written = spark.read.format(layout.fmt).load(path)
    out = {"orders_gold": path}
    for name, df in (("revenue_daily", gold.revenue_daily(written)), ("top_products", gold.top_products(written))):
        out[name] = layout.table("gold", name)
        write_overwrite(watch(name, df), out[name], layout.fmt)
    return out


def rebuild_inventory_gold(silver_inventory: DataFrame, layout: Layout, tests: ObservedTests | None = None) -> dict[str, str]:
    """inventory_gold (latest state + risk), inventory_alerts (non-healthy only, the batch
    job's table) and inventory_risk (all levels, 8 columns, the SQL model's table)."""
    valid = silver_inventory.filter(F.col("_dq_is_valid")) if "_dq_is_valid" in silver_inventory.columns \
        else silver_inventory
    out = {n: layout.table("gold", n) for n in ("inventory_gold", "inventory_alerts", "inventory_risk")}
    gold_df = inventory.inventory_gold(valid)
    write_overwrite(gold_df, out["inventory_gold"], layout.fmt)
    written = valid.sparkSession.read.format(layout.fmt).load(out["inventory_gold"])
    write_overwrite(inventory.inventory_alerts(written), out["inventory_alerts"], layout.fmt)
    risk = written.select(*inventory.RISK_MODEL_COLUMNS)
    write_overwrite(tests.watch("inventory_risk", risk) if tests else risk, out["inventory_risk"], layout.fmt)
    return out


def refresh(spark: SparkSession, layout: Layout, partition_by_date: bool = False,
            date_salt_buckets: int = DATE_SALT_BUCKETS, tests: ObservedTests | None = None) -> dict[str, str]:
    """Rebuild every gold table; `tests` counts the data tests while the tables are written."""
    written: dict[str, str] = {}
    orders = read_table_if_exists(spark, layout.table("silver", "orders"), layout.fmt)
    if orders is not None:
        written.update(rebuild_orders_gold(spark, orders, layout, partition_by_date, date_salt_buckets, tests))
    inv = read_table_if_exists(spark, layout.table("silver", "inventory"), layout.fmt)
    if inv is not None:
        written.update(rebuild_inventory_gold(inv, layout, tests))
    return written


# ---- refresh of what changed ---------------------------------------------------------------------

def refreshed_through(spark: SparkSession, layout: Layout) -> int:
    """The newest silver batch whose orders are in the tables by period; -1 before the first refresh."""
    done = read_table_if_exists(spark, layout.table("gold", "refresh_manifest"))
    newest = None if done is None else done.agg(F.max("through_batch")).first()[0]
    return -1 if newest is None else int(newest)


def period_of(day: str | Column, period: str = "day") -> Column:
    """The day itself, or the first day of its week, month, quarter or year."""
    c = F.col(day) if isinstance(day, str) else day
    return c if period == "day" else F.trunc(c, period)


def facts_of_periods(spark: SparkSession, layout: Layout, periods: list) -> DataFrame:
    """The order fact of the given periods (None: orders without a day); other periods' files are not read."""
    fact = spark.read.format(layout.fmt).load(layout.table("gold", "orders_gold_by_period"))
    chosen = F.col("order_period").isin([p for p in periods if p is not None])
    return fact.where(chosen | F.col("order_period").isNull() if None in periods else chosen)


def refresh_changed(spark: SparkSession, layout: Layout, period: str = "day",
                    date_salt_buckets: int = DATE_SALT_BUCKETS) -> dict[str, str]:
    """Bring `orders_gold_by_period` and `revenue_daily_by_period` up to date with the silver batches since the last
    refresh.

    Silver orders must be partitioned by `_batch_id` (shared-scan streams are).  Both tables are partitioned by
    `order_period`: the day, or a longer period where days hold few rows; a table keeps the period it began with.  Reads the
    new batches and the fact of the periods they touch; writes those periods only.  A row of the manifest names the newest
    batch taken over and is written last, so a refresh that failed half-way is simply repeated.  The driver holds one value
    per touched period.
    """
    silver = read_table_if_exists(spark, layout.table("silver", "orders"), layout.fmt)
    if silver is None:
        return {}
    if "_batch_id" not in silver.columns:
        raise ValueError("silver orders are not partitioned by _batch_id; use refresh")
    out = {n: layout.table("gold", n) for n in ("orders_gold_by_period", "revenue_daily_by_period")}
    through = refreshed_through(spark, layout)
    new = silver.where(F.col("_batch_id") > through)
    newest = new.agg(F.max("_batch_id")).first()[0]
    if newest is None:
        return out
    staged = new.where(F.col("_dq_is_valid")) if "_dq_is_valid" in new.columns else new
    fact = (staged.withColumn("event_ts", F.col("event_ts").cast("timestamp")).withColumn("order_date", F.to_date("event_ts"))
            .select(*gold.ORDER_FACT_COLUMNS, period_of("order_date", period).alias("order_period"), "_batch_id"))
    salt = F.pmod(F.xxhash64("order_id", "product_id", "event_ts"), F.lit(date_salt_buckets))
    replace_partitions(fact.repartition("order_period", "_batch_id", salt), out["orders_gold_by_period"],
                       ["order_period", "_batch_id"], layout.fmt)
    written = read_table_if_exists(spark, out["orders_gold_by_period"], layout.fmt)
    touched = written.where(F.col("_batch_id") > through).select("order_period").distinct()
    periods = [r["order_period"] for r in touched.collect()]
    daily = gold.revenue_daily(facts_of_periods(spark, layout, periods))
    daily = daily.withColumn("order_period", period_of("order_date", period)).repartition("order_period")
    replace_partitions(daily, out["revenue_daily_by_period"], ["order_period"], layout.fmt)
    row = spark.createDataFrame([(int(newest), len(periods))], "through_batch bigint, periods int")
    replace_partitions(row, layout.table("gold", "refresh_manifest"), ["through_batch"])
    return out
