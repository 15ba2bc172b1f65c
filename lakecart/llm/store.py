"""Work tables: lineage cuts written as Parquet under the session's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakecart.session import run_dir


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """`df` written to a fresh work table in the shared folder and read back.

    Tasks lost later re-read the table instead of recomputing what is above it.
    """
    spark: SparkSession = df.sparkSession
    path = f"{run_dir(spark, name)}.parquet"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
