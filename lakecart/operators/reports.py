"""Dashboard datasets (R1–R4; A4, A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecart.functions.money import round_money
from lakecart.operators.gold import rank_products
from lakecart.operators.inventory import ALERT_REPORT_COLUMNS


def revenue_trend(revenue_daily: DataFrame) -> DataFrame:
    """Revenue and margin over order date by category, channels rolled up (R1 = A5)."""
    return (revenue_daily.groupBy("order_date", "category")
            .agg(round_money(F.sum("revenue")).alias("revenue"),
                 round_money(F.sum("gross_margin")).alias("gross_margin"))
            .orderBy("order_date", "category"))


def orders_by_channel(orders_gold: DataFrame) -> DataFrame:
    """Distinct orders per channel (R2 = A4)."""
    return orders_gold.groupBy("channel").agg(F.countDistinct("order_id").alias("orders"))


def top_products_table(top_products: DataFrame) -> DataFrame:
    """Leaderboard table, four columns, revenue descending."""
    return rank_products(top_products).select("product_name", "category", "units_sold", "revenue")


def low_inventory_table(alerts: DataFrame) -> DataFrame:
    """Alert rows, five columns."""
    return alerts.select(*ALERT_REPORT_COLUMNS)
