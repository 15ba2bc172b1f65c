"""JSON-lines event files, one object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecart.contracts import contract
from lakecart.functions.time import as_timestamp_literal


def read_jsonl_events(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """Typed read with the topic's declared schema (never inferred)."""
    return spark.read.schema(contract(topic).schema).json(path)


def jsonl_envelope(spark: SparkSession, path: str, topic: str, stream: bool = False,
                   ingested_at=None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw lines as the envelope, so parsing and quality checks are the bus path's own.

    The file path stands in for the bus key and the file time for the bus time;
    partition and offset do not exist for files and stay null.
    """
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    raw = reader.text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("kafka_key"),
        F.col("value").alias("payload"),
        F.lit(topic).alias("kafka_topic"),
        F.lit(None).cast("int").alias("kafka_partition"),
        F.lit(None).cast("bigint").alias("kafka_offset"),
        F.col("_metadata.file_modification_time").alias("kafka_timestamp"),
        as_timestamp_literal(ingested_at).alias("_ingested_at"),
    )
