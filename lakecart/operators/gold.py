"""Silver orders → gold: enrichment, staged model, order fact, revenue and leaderboard.

J1, P4–P9, F3, A1–A3, O1–O2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.functions.money import gross_margin, round_money
from lakecart.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, join_dimension

# Output columns in the order that readers of the tables expect, and the grouping keys.
ORDER_FACT_COLUMNS = ["order_id", "order_date", "event_ts", "user_id", "product_id", "product_name",
                      "category", "brand", "store_id", "channel", "quantity", "unit_price",
                      "order_total", "gross_margin", "status"]
STAGED_ORDER_COLUMNS = ["order_id", "event_ts", "order_date", "user_id", "product_id", "product_name",
                        "category", "brand", "store_id", "channel", "quantity", "unit_price",
                        "order_total", "gross_margin", "status"]
STAGED_INVENTORY_COLUMNS = ["product_id", "sku", "store_id", "event_ts", "on_hand", "available_to_promise",
                            "reorder_point", "change_quantity", "reason"]
REVENUE_DAILY_KEY = ["order_date", "category", "channel"]
REVENUE_INCREMENT_KEY = ["order_date", "product_id", "product_name", "category", "channel"]
DIMENSION_COLUMNS = ["product_name", "category", "brand", "cost", "catalog_reorder_point"]
LEADERBOARD_KEY = ["product_id", "product_name", "category", "brand"]


def with_dimensions(orders: DataFrame, catalog: DataFrame,
                    broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
                    salt_buckets: int | None = None) -> DataFrame:
    """Left join with the typed catalog on product_id; unmatched rows keep null dimensions.

    `catalog` has product_id and the `DIMENSION_COLUMNS`.
    Only those columns are taken, so the scan below is pruned to them.
    """
    dim = catalog.select("product_id", *DIMENSION_COLUMNS)
    return join_dimension(orders, dim, "product_id", "left", broadcast_max_rows, salt_buckets=salt_buckets)


def with_margin(enriched: DataFrame) -> DataFrame:
    return enriched.withColumn("gross_margin", gross_margin("unit_price", "cost", "quantity"))


def enrich_orders(orders: DataFrame, catalog: DataFrame,
                  broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
                  salt_buckets: int | None = None) -> DataFrame:
    """Orders with the catalog's dimensions (`with_dimensions`) and their gross margin."""
    return with_margin(with_dimensions(orders, catalog, broadcast_max_rows, salt_buckets))


def _valid_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_dq_is_valid")) if "_dq_is_valid" in df.columns else df


def stage_orders(silver_orders: DataFrame) -> DataFrame:
    """Staged orders view (P8): valid rows (F3), typed time, order date, 15 columns."""
    return (_valid_only(silver_orders)
            .withColumn("event_ts", F.col("event_ts").cast("timestamp"))
            .withColumn("order_date", F.to_date("event_ts"))
            .select(*STAGED_ORDER_COLUMNS))


def stage_inventory(silver_inventory: DataFrame) -> DataFrame:
    """Staged inventory view (P9): valid rows, typed time, 9 columns."""
    return (_valid_only(silver_inventory)
            .withColumn("event_ts", F.col("event_ts").cast("timestamp"))
            .select(*STAGED_INVENTORY_COLUMNS))


def orders_fact(enriched_orders: DataFrame) -> DataFrame:
    """Order fact (P5, P6): the fixed 15-column projection with `order_date`."""
    return enriched_orders.withColumn("order_date", F.to_date("event_ts")).select(*ORDER_FACT_COLUMNS)


def _sales_metrics(*names: str) -> list[Column]:
    """The named sales metrics, by default all."""
    metrics = {
        "orders": F.countDistinct("order_id"),
        "units_sold": F.sum("quantity"),
        "revenue": round_money(F.sum("order_total")),
        "gross_margin": round_money(F.sum("gross_margin")),
    }
    return [metrics[n].alias(n) for n in names or metrics]


def revenue_daily(fact: DataFrame) -> DataFrame:
    """Per day × category × channel: distinct orders, units, revenue, margin (A1).  All statuses count."""
    return fact.groupBy(*REVENUE_DAILY_KEY).agg(*_sales_metrics())


def top_products(fact: DataFrame) -> DataFrame:
    """Leaderboard: units, revenue, distinct orders per product (A2), from a fact that holds the dimensions."""
    return fact.groupBy(*LEADERBOARD_KEY).agg(*_sales_metrics("units_sold", "revenue", "orders"))


def top_products_of(orders: DataFrame, catalog: DataFrame,
                    broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """The leaderboard of `top_products`, from orders and catalog: sales are summed per product before the join.

    Distinct orders are counted over (product_id, order_id) alone, so no task holds name, category and brand once an
    order.  A product that the catalog lists n times in the same words counts its sales n times, as the join of all
    orders does; listed in other words, it has a row for each.
    """
    sales = orders.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"), F.sum("order_total").alias("revenue"),
                                             F.countDistinct("order_id").alias("orders"))
    named = join_dimension(sales, catalog.select(*LEADERBOARD_KEY), "product_id", "left", broadcast_max_rows)
    return named.groupBy(*LEADERBOARD_KEY).agg(
        F.sum("units_sold").alias("units_sold"), round_money(F.sum("revenue")).alias("revenue"),
        F.max("orders").alias("orders"))


def revenue_increment(batch: DataFrame, batch_id: int | str | Column) -> DataFrame:
    """Revenue increment at product grain for one micro-batch (A3), tagged with `_batch_id`.

    `batch_id` may be a column to compute several batches at once.  Distinct order
    counts of different batches do not add up; day totals come from `revenue_daily`.
    """
    if isinstance(batch_id, str):
        bid = F.col(batch_id)
    elif isinstance(batch_id, Column):
        bid = batch_id
    else:
        bid = F.lit(int(batch_id))
    df = batch.withColumn("order_date", F.to_date("event_ts")).withColumn("_batch_id", bid.cast("bigint"))
    return df.groupBy("_batch_id", *REVENUE_INCREMENT_KEY).agg(*_sales_metrics())


def order_revenue_daily(revenue: DataFrame) -> DataFrame:
    """Report order for daily revenue (O1)."""
    return revenue.orderBy(*REVENUE_DAILY_KEY)


def rank_products(leaderboard: DataFrame) -> DataFrame:
    """Leaderboard order: revenue descending, product id as tie-break (O2)."""
    return leaderboard.orderBy(F.desc_nulls_last("revenue"), F.asc("product_id"))
