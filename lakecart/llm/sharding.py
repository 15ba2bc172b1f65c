"""Sharding by sampled splitters (dealt operator 8, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecart.llm.store import written

SHARDS = 40
OVERHEAD_BYTES = 16
# Ranges per shard and samples per range; a range over OVERFULL times the mean is subdivided.
RANGES_PER_SHARD, SAMPLES_PER_RANGE, OVERFULL = 8, 24, 2
# Keys of a part of a range that one task sorts.
PART_KEYS = 50_000
# A group of equal texts stays whole up to this share of a shard's bytes and this many rows.
GROUP_SHARE, GROUP_ROWS = 0.02, 512


def _range_of(key: Column, splitters: list[int]) -> Column:
    """Number of splitters at or below the key: a binary search over a constant array."""
    if not splitters:
        return F.lit(0)
    bounds = F.split(F.lit(",".join(map(str, splitters))), ",").cast("array<bigint>")
    n = len(splitters)
    step = lambda a, _: F.when(a["lo"] >= a["hi"], a).otherwise(F.when(
        F.element_at(bounds, (F.floor((a["lo"] + a["hi"]) / 2) + 1).cast("int")) <= key,
        F.struct((F.floor((a["lo"] + a["hi"]) / 2) + 1).cast("int").alias("lo"), a["hi"].alias("hi"))).otherwise(
        F.struct(a["lo"].alias("lo"), F.floor((a["lo"] + a["hi"]) / 2).cast("int").alias("hi"))))
    start = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(n.bit_length())), start, step, lambda a: a["lo"])


def splitters(keys: DataFrame, ranges: int, total: int) -> list[int]:
    """At most `ranges` - 1 quantile boundaries of a size-weighted sample of (key, bytes).

    A key's chance is its bytes over the mean bytes a sample stands for, decided by a hash: reruns agree.  A key that
    stands for several samples counts as often.
    """
    unit = max(1.0, total / (ranges * SAMPLES_PER_RANGE))
    times = F.floor(F.col("bytes") / unit + F.pmod(F.xxhash64(F.col("key"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30))
    drawn = keys.select("key", times.alias("times")).where("times > 0")
    order = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    # One task over the sample: `ranges` * SAMPLES_PER_RANGE keys on average, whatever the number of rows.
    ranked = drawn.withColumn("upto", F.sum("times").over(order)).withColumn(
        "all", F.sum("times").over(Window.partitionBy()))
    cut = F.floor(F.col("upto") * F.lit(ranges) / F.col("all"))
    before = F.floor((F.col("upto") - F.col("times")) * F.lit(ranges) / F.col("all"))
    cuts = ranked.where((cut > before) & (cut < ranges)).select("key").distinct()
    return sorted(r["key"] for r in cuts.collect())


def subdivided(ranged: DataFrame, limit: int) -> DataFrame:
    """`ranged` (range, part, key, …), distinct keys in parts of at most `limit` keys; parts are in key order.

    A part over the limit is cut evenly between its first and last key, again and again while one is left: where keys
    lie close together, each round looks at a smaller stretch.  A part is named by the key where it begins.
    """
    while True:
        full = ranged.groupBy("range", "part").agg(F.count("*").alias("n"), F.min("key").alias("first"), F.max("key").alias("last"))
        full = written(full.where(F.col("n") > limit).select(
            "range", "part", "first", F.expr(f"(last - first) div ceil(n / {limit}) + 1").alias("width")), "shard-overfull")
        if full.isEmpty():
            return ranged
        begin = F.expr("first + (key - first) div width * width")
        ranged = written(ranged.join(full, ["range", "part"], "left").withColumn(
            "part", F.when(F.col("first").isNull(), F.col("part")).otherwise(begin)).drop("first", "width"), "shard-subranges")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: near equal bytes in each shard.

    Records are ordered by a key, the text's CRC-32 above a hash of the doc_id, so equal texts are neighbours; a
    group of equal CRC that is small (GROUP_SHARE, GROUP_ROWS) shares one key and is never split, a larger one is
    spread over its records.  Size-weighted samples of the keys give quantile boundaries that cut the key space into
    a fixed number of ranges; ranges that turn out overfull are subdivided by key.  Running sums over ranges, over a
    range's parts and within each part place every key at its exact byte offset: its middle decides the shard, so
    shards differ from the even share by at most about one key's bytes.  slot: gapless from 0 within a shard, in key order.

    Only narrow rows move; texts do not.  Null text: no bytes, CRC 0.  Repeated rows share a key and count each; they
    are counted before the windows and spread by arithmetic, so a key of any number of rows is safe.  An empty table
    gives no rows.  Other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(OVERHEAD_BYTES)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    # Repeated rows become one row with their number.
    rows = written(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("times")), "shard-rows")
    total = rows.agg(F.sum(F.col("size") * F.col("times"))).first()[0] or 0

    groups = rows.groupBy("text_crc32").agg(F.sum(F.col("size") * F.col("times")).alias("b"), F.sum("times").alias("n"))
    large = groups.where((F.col("b") > GROUP_SHARE * total / shards) | (F.col("n") > GROUP_ROWS))
    large = written(large.select(F.col("text_crc32").alias("crc")), "shard-groups")
    own = F.when(F.col("crc").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))).otherwise(0)
    key = F.shiftleft(F.col("text_crc32"), 31) + own
    keyed = rows.join(large, rows.text_crc32 == large.crc, "left").select("doc_id", "size", "text_crc32", "times", key.alias("key"))
    keyed = written(keyed, "shard-keys")

    keys = keyed.groupBy("key").agg(F.sum(F.col("size") * F.col("times")).alias("bytes"), F.sum("times").alias("rows"))
    ranges = shards * RANGES_PER_SHARD
    cuts = splitters(keys, ranges, total)
    ranged = written(keys.withColumn("range", _range_of(F.col("key"), cuts)).withColumn("part", F.lit(0).cast("long")), "shard-ranges")
    mean = ranged.count() / max(1, len(cuts) + 1)
    ranged = subdivided(ranged, max(1, min(PART_KEYS, int(OVERFULL * mean))))

    sums = ranged.groupBy("range", "part").agg(F.sum("bytes").alias("b"), F.sum("rows").alias("n"))
    sums = written(sums, "shard-sums")

    def offsets(table: DataFrame, order: Window, bytes_: str, rows_: str) -> DataFrame:
        return table.withColumn(bytes_, F.coalesce(F.sum("b").over(order), F.lit(0))).withColumn(
            rows_, F.coalesce(F.sum("n").over(order), F.lit(0))).drop("b", "n")

    earlier = Window.unboundedPreceding, -1
    # One row per range, a fixed number; then one row per part within each range.
    of_range = offsets(sums.groupBy("range").agg(F.sum("b").alias("b"), F.sum("n").alias("n")),
                       Window.orderBy("range").rowsBetween(*earlier), "b0", "n0")
    of_part = offsets(sums, Window.partitionBy("range").orderBy("part").rowsBetween(*earlier), "b1", "n1")
    within = Window.partitionBy("range", "part").orderBy("key").rowsBetween(*earlier)
    placed = ranged.select("*", F.coalesce(F.sum("bytes").over(within), F.lit(0)).alias("b2"),
                           F.coalesce(F.sum("rows").over(within), F.lit(0)).alias("n2"))
    placed = placed.join(of_part, ["range", "part"]).join(F.broadcast(of_range), "range").select(
        "key", (F.col("b0") + F.col("b1") + F.col("b2")).alias("at_byte"), (F.col("n0") + F.col("n1") + F.col("n2")).alias("at_row"),
        "bytes", "rows")
    # Rows of one key: doc_id order; a small group's key goes whole, any other key holds repeats of one document.
    placed = written(placed, "shard-places")
    order = Window.partitionBy("key").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    spread = keyed.join(placed, "key").withColumn("before", F.coalesce(F.sum("times").over(order), F.lit(0)))
    spread = spread.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    spread = spread.withColumn("row", F.col("at_row") + F.col("before") + F.col("i"))
    big = F.col("rows") > GROUP_ROWS  # repeats of one document beyond any group: each row by its own middle
    middle = F.when(big, F.col("at_byte") + (F.col("before") + F.col("i")) * F.col("size") + F.col("size") / 2).otherwise(
        F.col("at_byte") + F.col("bytes") / 2)
    spread = spread.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(float(max(1, total))))).cast("int"))
    spread = spread.select("doc_id", "size", "text_crc32", "shard", "row")
    spread = written(spread, "shard-spread")
    first = spread.groupBy("shard").agg(F.min("row").alias("first"))  # at most `shards` rows
    return spread.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"))
