"""Writers: append streams (K1), full replace (K3), per-batch partition replace (K2), publish (K5), models (K6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakecart.functions.fingerprint import fingerprint
from lakecart.functions.jsonfmt import canonical_json
from lakecart.session import FREE_SHUFFLES, session_settings

# JSON payloads and hex keys take about half the space that they take under the default codec.
COMPRESSION = "zstd"


def write_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                 fmt: str = "parquet", output_mode: str = "append", query_name: str | None = None,
                 processing_time: str | None = None) -> StreamingQuery:
    """Append sink with its own checkpoint; `available_now` drains what is there and stops."""
    writer = (df.writeStream.format(fmt).outputMode(output_mode)
              .option("checkpointLocation", checkpoint).option("compression", COMPRESSION))
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(path)


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Full replace; the new schema replaces the old one."""
    writer = df.write.format(fmt).mode("overwrite").option("compression", COMPRESSION)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet") -> None:
    """Overwrite only the partitions present in `df` (dynamic partition overwrite).

    Writing the same micro-batch twice (replay after a failure) leaves one copy.
    """
    (df.write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
     .partitionBy(*partition_by).save(path))


def replace_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> DataFrame | None:
    """Write a micro-batch as its `_batch_id` partition of a table and return the rows as written; None if there are none.

    What else is made of the batch starts from the written rows: the batch is computed once, in every partition, and
    neither held in memory nor on local disks, however large it is.
    """
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("_batch_id", F.lit(int(batch_id)).cast("bigint"))
    replace_partitions(rows, path, ["_batch_id"], fmt)
    if not seen.get["rows"]:
        return None
    reader = df.sparkSession.read.format(fmt)
    if fmt == "parquet":
        reader = reader.schema(rows.schema)
    return reader.load(path).where(F.col("_batch_id") == int(batch_id)).select(*df.columns)


def free_micro_batch(batch_df: DataFrame) -> None:
    """Remove the shuffle files of a micro-batch that has been written whole, before what is made of the written rows.

    Only for the frame that a stream hands to `foreachBatch`: it stands on the batch's own data, and naming that runs no job.
    Should an executor be lost later, the batch is replayed from the source as ever.
    """
    rows = batch_df.rdd
    rows.getNumPartitions()                            # dependencies are known from here on
    rows.cleanShuffleDependencies()


def publish_frame(df: DataFrame, topic: str, key_columns: list[str], value_columns: list[str] | None = None,
                  num_partitions: int | None = None, partition=None, offset=None,
                  timestamp=None, value=None) -> DataFrame:
    """Bus records: key = fingerprint of the key columns, value = sorted-key JSON of the event (K5, X2),
    or the given `value` column (text).

    Partition follows the key hash when the bus partition count is given.  `offset` is
    only for file-backed buses; a real bus assigns its own.
    """
    key = fingerprint(df, key_columns)
    cols = [
        key.cast("binary").alias("key"),
        (value if value is not None else canonical_json(value_columns)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    ]
    if partition is not None:
        cols.append(partition.cast("int").alias("partition"))
    elif num_partitions:
        cols.append(F.pmod(F.hash(key), F.lit(int(num_partitions))).cast("int").alias("partition"))
    else:
        cols.append(F.lit(None).cast("int").alias("partition"))
    cols.append((offset if offset is not None else F.monotonically_increasing_id()).cast("bigint").alias("offset"))
    cols.append((timestamp if timestamp is not None else F.current_timestamp()).cast("timestamp").alias("timestamp"))
    return df.select(*cols)


def publish_to_bus(records: DataFrame, servers: str) -> None:
    """Send bus records to a Kafka-compatible bus (needs the connector on the classpath).

    A record's own partition is used; where it is null the bus's partitioner chooses.
    """
    (records.select("key", "value", "topic", "partition")
     .write.format("kafka").option("kafka.bootstrap.servers", servers).save())


def publish_to_files(records: DataFrame, path: str) -> None:
    """Append bus records to a file-backed bus (parquet), the twin read by `file_bus_stream`."""
    with session_settings(records.sparkSession, FREE_SHUFFLES):
        records.write.mode("append").option("compression", COMPRESSION).parquet(path)


def materialize(spark: SparkSession, df: DataFrame, name: str, kind: str = "view",
                path: str | None = None, fmt: str = "parquet") -> None:
    """Model materialisation (K6): temp view, or a table written to `path` and registered."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        if path is None:
            df.write.mode("overwrite").format(fmt).saveAsTable(name)
        else:
            write_overwrite(df, path, fmt)
            spark.read.format(fmt).load(path).createOrReplaceTempView(name)
    else:
        raise ValueError(f"unknown materialisation {kind!r}")
