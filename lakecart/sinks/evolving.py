"""Appends to a table whose schema may grow (§1.3): every commit records the merged schema, old and new files read as one.

Added columns and widened types are taken over; a type that would lose values, or another kind of type, is refused before
anything is written.  Files stay as they were written: Parquet readers widen them, and columns they lack are null.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecart.sinks.writers import replace_partitions
from lakecart.sources.tables import read_table_if_exists

MAX_DIGITS = 38
# Whole numbers, each holding all values of those before it.
_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


class SchemaConflict(ValueError):
    """A commit whose schema the table cannot take over."""


def _widest(have: T.DataType, new: T.DataType, where: str) -> T.DataType:
    a, b = type(have), type(new)
    if a in _WHOLE and b in _WHOLE:
        return have if _WHOLE.index(a) >= _WHOLE.index(b) else new
    if {a, b} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if (a in _WHOLE[:3] and b is T.DoubleType) or (b in _WHOLE[:3] and a is T.DoubleType):
        return T.DoubleType()
    if a is b is T.DecimalType:
        scale = max(have.scale, new.scale)
        digits = max(have.precision - have.scale, new.precision - new.scale) + scale
        if digits <= MAX_DIGITS:
            return T.DecimalType(digits, scale)
    elif {a, b} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    elif a is b is T.StructType:
        return merged_schema(have, new, f"{where}.")
    elif a is b is T.ArrayType:
        return T.ArrayType(_widest(have.elementType, new.elementType, f"{where}[]"))
    elif a is b is T.MapType:
        return T.MapType(_widest(have.keyType, new.keyType, f"{where}.key"), _widest(have.valueType, new.valueType, f"{where}.value"))
    if have == new:
        return have
    raise SchemaConflict(f"{where}: {new.simpleString()} does not fit {have.simpleString()}")


def merged_schema(have: T.StructType, new: T.StructType, where: str = "") -> T.StructType:
    """The table's columns in their order, widened where needed, then the new ones; all nullable."""
    incoming = {f.name: f.dataType for f in new.fields}
    fields = [T.StructField(f.name, _widest(f.dataType, incoming.pop(f.name), where + f.name) if f.name in incoming else f.dataType)
              for f in have.fields]
    return T.StructType(fields + [T.StructField(n, t) for n, t in incoming.items()])


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def recorded_schema(spark: SparkSession, path: str, before: int | None = None) -> T.StructType | None:
    """The schema that the newest commit (before the given one) recorded; None for a table without commits."""
    log = read_table_if_exists(spark, f"{path.rstrip('/')}/schemas")
    if log is None:
        return None
    if before is not None:
        log = log.where(F.col("_commit") < before)
    newest = log.agg(F.max_by("schema", "_commit")).first()[0]
    return None if newest is None else T.StructType.fromJson(json.loads(newest))


def append_evolving(df: DataFrame, path: str, commit: int) -> T.StructType:
    """Append `df` as a commit and return the table's schema; commits grow, a repeated one replaces itself.

    The schema is recorded before the rows are written, so a reader never meets a file that its schema does not cover.
    A repeated column name (up to case) is refused.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names) or "_commit" in names:
        raise SchemaConflict("column names must differ, also from _commit")
    have = recorded_schema(spark, root, commit)
    if have is not None:
        spelled = {f.name.lower(): f.name for f in have.fields}
        df = df.select(*[F.col(f"`{c}`").alias(spelled.get(c.lower(), c)) for c in df.columns])
    schema = _nullable(df.schema) if have is None else merged_schema(have, _nullable(df.schema))
    tag = F.lit(int(commit)).cast("bigint")
    row = spark.createDataFrame([(schema.json(),)], "schema string").withColumn("_commit", tag)
    replace_partitions(row, f"{root}/schemas", ["_commit"])
    wide = {f.name: f.dataType for f in schema.fields}
    rows = df.select(*[F.col(f"`{c}`").cast(wide[c]).alias(c) for c in df.columns])
    replace_partitions(rows.withColumn("_commit", tag), f"{root}/rows", ["_commit"])
    return schema


def read_evolving(spark: SparkSession, path: str) -> DataFrame | None:
    """The whole table in its newest schema; None without commits."""
    root = path.rstrip("/")
    schema = recorded_schema(spark, root)
    if schema is None:
        return None
    return spark.read.schema(schema).parquet(f"{root}/rows").select(*[F.col(f"`{f.name}`") for f in schema.fields])
