"""Message-bus source (S1) and the envelope projection every source shares.

The bus record layout is Kafka's: key/value binary, topic, partition, offset,
timestamp.  `file_bus_stream` reads the same layout from parquet files, so the
envelope projection and everything downstream are identical for both; the file
twin is what runs in tests (no bus connector is installed here).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecart.functions.time import as_timestamp_literal

# The bus connector's record columns, and the envelope columns that silver and bronze tables carry.
BUS_RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

ENVELOPE_COLUMNS = ["kafka_key", "payload", "kafka_topic", "kafka_partition", "kafka_offset",
                    "kafka_timestamp", "_ingested_at"]


def bus_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
               fail_on_data_loss: bool = False, max_offsets_per_trigger: int | None = None,
               min_partitions: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """One subscription on a Kafka-compatible bus.  `earliest` so a drain run finds data.

    `max_offsets_per_trigger` bounds a micro-batch, and with it what one hot key can
    put on one state-store task in one trigger.  `min_partitions` lets Spark split a
    large bus partition into several read tasks, so one hot bus partition is not
    read by one task.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", int(min_partitions))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def file_bus_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Bus records stored as parquet files (twin of `bus_stream`)."""
    reader = spark.readStream.schema(BUS_RECORD_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(path)


def envelope(records: DataFrame, ingested_at: datetime | str | Column | None = None) -> DataFrame:
    """Bus records → the 7-column envelope: text key and payload, renamed metadata, arrival stamp."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("payload"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        as_timestamp_literal(ingested_at).alias("_ingested_at"),
    )


def bronze(envelope_df: DataFrame, topic: str) -> DataFrame:
    """Bronze rows: the envelope plus the topic tag."""
    return envelope_df.withColumn("topic", F.lit(topic))
