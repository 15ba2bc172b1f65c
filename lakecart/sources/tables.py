"""Layer-table scans (S4) and named warehouse sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from lakecart.sinks.layout import Layout


def read_table_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """Load a path-addressed table; an absent path means "no table" (works on object stores), and so does one without a
    data file: a batch without rows leaves a folder."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as exc:
        said = f"{getattr(exc, 'getCondition', lambda: '')() or ''} {exc}"
        if "PATH_NOT_FOUND" in said or "UNABLE_TO_INFER_SCHEMA" in said:
            return None
        raise


def register_sources(spark: SparkSession, layout: Layout) -> list[str]:
    """Register silver orders/inventory as the views `orders_silver`, `inventory_silver`."""
    names = []
    for topic, view in (("orders", "orders_silver"), ("inventory", "inventory_silver")):
        df = read_table_if_exists(spark, layout.table("silver", topic), layout.fmt)
        if df is not None:
            df.createOrReplaceTempView(view)
            names.append(view)
    return names
