"""Product catalog (S3, S6): CSV with a header, read as text, typed with `try_cast`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG_CSV_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in (
    "product_id", "sku", "product_name", "category", "brand", "base_price", "cost", "reorder_point")])


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; a declared schema, so no inference pass over the file."""
    return spark.read.schema(CATALOG_CSV_SCHEMA).option("header", True).csv(path)


def typed_catalog(raw: DataFrame) -> DataFrame:
    """The six columns orders are enriched with.  Bad numbers become null (ANSI-safe)."""
    return raw.select(
        "product_id", "product_name", "category", "brand",
        F.col("cost").try_cast("double").alias("cost"),
        F.col("reorder_point").try_cast("int").alias("catalog_reorder_point"),
    )


def duplicate_keys(catalog: DataFrame, key: str = "product_id") -> DataFrame:
    """Keys that occur more than once (they would multiply joined facts)."""
    return catalog.groupBy(key).count().filter(F.col("count") > 1)


def load_catalog(spark: SparkSession, path: str, check_unique: bool = True) -> DataFrame:
    cat = typed_catalog(read_catalog_csv(spark, path))
    if check_unique:
        dup = duplicate_keys(cat).limit(5).collect()
        if dup:
            raise ValueError(f"catalog has duplicate product_id values: {[r[0] for r in dup]}")
    return cat
