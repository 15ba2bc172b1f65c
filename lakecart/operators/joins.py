"""Dimension joins with a checked broadcast.

A dimension is broadcast only when one bounded job proves it small in rows and in
bytes; otherwise the join is left to the planner (sort-merge, or AQE's runtime
switch to broadcast for batch plans).  The job reads at most `max_rows + 1` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_MAX_ROWS = 200_000
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Of stream joins beyond the bound.
DEFAULT_SALT_BUCKETS = 16


_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4,
          T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16}


def _value_bytes(field: T.StructField) -> Column:
    """Approximate in-memory bytes of one value: text/binary by length, the rest by type width."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + F.lit(8)
    return F.lit(_WIDTH.get(type(field.dataType), 8))


def fits_broadcast(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> bool:
    """True when `dim` has at most `max_rows` rows and about `max_bytes` of values.

    One job over at most max_rows + 1 rows counts them and sums their value sizes.
    Nothing is remembered: a dimension rewritten in place is measured anew.
    """
    size = sum((_value_bytes(f) for f in dim.schema.fields), F.lit(0))
    row = dim.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return row.n <= max_rows and (row.b or 0) <= max_bytes


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left",
                   broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
                   broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
                   salt_buckets: int | None = None) -> DataFrame:
    """`fact ⋈ dim`, broadcasting `dim` only behind `fits_broadcast`.

    Beyond the bound the join shuffles.  With `salt_buckets` (for streams, where AQE's
    skew splitting does not run) each fact row gets a deterministic salt and the
    dimension is copied once per salt value, so one hot key is spread over
    `salt_buckets` tasks; every fact row still meets exactly one copy of its match.  The planner sizes the copied
    dimension by the files of one copy, so it is told to merge: else it would broadcast `salt_buckets` copies.
    `broadcast_max_rows=None` skips the check and leaves the choice to Spark.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if broadcast_max_rows is not None and fits_broadcast(dim, broadcast_max_rows, broadcast_max_bytes):
        return fact.join(F.broadcast(dim), on=keys, how=how)
    if not salt_buckets or salt_buckets <= 1:
        return fact.join(dim, on=keys, how=how)
    salted_fact = fact.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]),
                                                  F.lit(int(salt_buckets))).cast("int"))
    salted_dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(int(salt_buckets) - 1))))
    return salted_fact.join(salted_dim.hint("merge"), on=[*keys, "_salt"], how=how).drop("_salt")
