"""A stock ledger that continues (W2): new events are merged into a stored one.

The store holds, per run, ledger rows with running sums local to their (key, time bucket), and a summary per touched
(key, bucket): the sum of its deltas, the least prefix sum, the last row.  The summaries form a monoid, so a bucket that
only grows at its end is continued from its summary alone; one that gets events in between is computed again from
its own rows.  Offsets between buckets are added when the ledger is read, so a late event rewrites its bucket and no
later one.  Runs are only added, never changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakecart.operators.inventory import INVENTORY_KEY, plain_key, time_bucket
from lakecart.sinks.writers import replace_partitions, write_overwrite
from lakecart.sources.tables import read_table_if_exists

_STATE = ["_seg", "_tb", "_d", "_init", "_ls", "_lmin"]


class LedgerStore:
    """Ledger of `delta` per key under `path`, floored at zero (the semantics of `inventory.stock_ledger`).

    `bucket` is the width of a time bucket in seconds (or units of a numeric order column).  All runs of a store must use
    the same arguments and columns.  Rows that tie on `order` go by a hash of the whole row.  Null keys are a key of
    their own, null deltas count 0, null times come first.  `initial` is an integer or a column constant per key.
    """

    def __init__(self, path: str, delta: str = "change_quantity", initial: int | str = 0, keys: list[str] | None = None,
                 order: list[str] | None = None, bucket: int = 86_400, out: str = "ledger_on_hand",
                 bucket_tasks: int = 4):
        self.rows_path, self.segs_path = f"{path.rstrip('/')}/rows", f"{path.rstrip('/')}/segments"
        self.touched_path = f"{path.rstrip('/')}/touched"
        self.delta, self.initial, self.bucket, self.out = delta, initial, bucket, out
        self.keys, self.order = keys or INVENTORY_KEY, order or ["event_ts", "event_id"]
        self.own, self.bucket_tasks = [f"_k{i}" for i in range(2 * len(self.keys))], bucket_tasks

    def _last(self) -> Column:
        return F.struct(*[F.col(f"`{c}`") for c in self.order], F.col("_tb"))

    def _prepared(self, df: DataFrame) -> DataFrame:
        init = F.lit(self.initial) if isinstance(self.initial, int) else F.col(self.initial)
        plain = dict(zip(self.own, [c for k in self.keys for c in plain_key(df, k)], strict=True))
        return df.withColumns({**plain, "_seg": time_bucket(df, self.order[0], self.bucket),
                               "_tb": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]),
                               "_d": F.coalesce(F.col(self.delta).cast("bigint"), F.lit(0)), "_init": init.cast("bigint")})

    def _segments(self, spark: SparkSession, before: int | None) -> DataFrame | None:
        """The newest summary of each (key, bucket), from runs before `before`."""
        segs = read_table_if_exists(spark, self.segs_path)
        if segs is None:
            return None
        if before is not None:
            segs = segs.where(F.col("_run") < before)
        values = [c for c in segs.columns if c not in (*self.own, "_seg")]
        newest = F.max_by(F.struct(*values), "_run").alias("_s")
        return segs.groupBy(*self.own, "_seg").agg(newest).select(*self.own, "_seg", "_s.*")

    def append(self, events: DataFrame, run: int) -> None:
        """Merge new events as run `run`; runs must grow, a repeated run replaces itself.

        Reads: the events twice, the summaries, and stored rows only of time buckets between the first and the last one
        that got an event before its stored end.
        """
        spark, own, by = events.sparkSession, self.own, [*self.own, "_seg"]
        new = self._prepared(events)
        stored = self._segments(spark, run)
        tag = F.lit(int(run)).cast("bigint")
        if stored is None:
            work = new.withColumns({"_base": F.lit(0).cast("bigint"), "_basemin": F.lit(None).cast("bigint"),
                                    "_from": tag, "_kept": F.lit(None).cast("boolean")})
        else:
            first = new.groupBy(*by).agg(F.min(self._last()).alias("_first"))
            touched = first.join(stored, by, "left").select(
                *by, F.coalesce(F.col("_first") <= F.col("last"), F.lit(False)).alias("_again"), "tot", "low", "from_run")
            # written once: three jobs read it, and each would shuffle all events again for it
            written = f"{self.touched_path}/run={int(run)}"
            write_overwrite(touched, written)
            touched = spark.read.schema(touched.schema).parquet(written)
            # summaries that go on are taken over; the others start anew from their own rows
            grows = ~F.col("_again") & F.col("from_run").isNotNull()
            state = touched.select(*by, "_again", F.when(grows, F.col("tot")).otherwise(0).alias("_base"),
                                   F.when(grows, F.col("low")).alias("_basemin"),
                                   F.when(grows, F.col("from_run")).otherwise(tag).alias("_from"),
                                   F.col("from_run").alias("_old_from"))
            work = new.join(state.select(*by, "_base", "_basemin"), by)
            span = touched.where("_again").agg(F.min("_seg"), F.max("_seg")).first()
            if span[0] is not None:
                old = spark.read.parquet(self.rows_path).where((F.col("_run") < run) & F.col("_seg").between(*span))
                old = old.join(state.where("_again"), by).where(F.col("_run") >= F.col("_old_from"))
                work = work.unionByName(old.select(*new.columns, "_base", "_basemin"))
        # one shuffle serves the window and the files: a bucket's keys in `bucket_tasks` parts
        work = work.withColumn("_part", F.pmod(F.xxhash64(*own), F.lit(self.bucket_tasks))).repartition("_seg", "_part")
        w = Window.partitionBy(*by, "_part").orderBy(*self.order, "_tb").rowsBetween(Window.unboundedPreceding, 0)
        local = work.withColumn("_ls", F.col("_base") + F.sum("_d").over(w))
        local = local.withColumn("_lmin", F.least("_basemin", F.min("_ls").over(w)))
        columns = [F.col(f"`{c}`") for c in events.columns]
        rows = local.select(*columns, *own, *_STATE, tag.alias("_run"))
        replace_partitions(rows, self.rows_path, ["_run", "_seg"])
        # from the rows just written, so the window runs once
        done = spark.read.parquet(self.rows_path).where(F.col("_run") == run)
        sums = done.groupBy(*by).agg(F.max_by("_ls", self._last()).alias("tot"), F.min("_lmin").alias("low"),
                                     F.max(self._last()).alias("last"))
        if stored is None:
            sums = sums.withColumn("from_run", tag)
        else:
            sums = sums.join(state.select(*by, F.col("_from").alias("from_run")), by)
        replace_partitions(sums.withColumn("_run", tag), self.segs_path, ["_run"])

    def ledger(self, spark: SparkSession) -> DataFrame:
        """Every stored event once, with its running stock in `out`."""
        by = [*self.own, "_seg"]
        before = Window.partitionBy(*self.own).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
        segs = self._segments(spark, None)
        segs = (segs.withColumn("_off", F.coalesce(F.sum("tot").over(before), F.lit(0)))
                .withColumn("_pmin", F.min(F.col("_off") + F.col("low")).over(before))
                .select(*by, "from_run", "_off", "_pmin"))
        rows = spark.read.parquet(self.rows_path)
        names = [c for c in rows.columns if c not in (*self.own, *_STATE, "_run", self.out)]
        level = F.col("_init") + F.col("_off")
        least = F.least(level + F.col("_lmin"), F.col("_init") + F.col("_pmin"))
        return (rows.join(segs, by).where(F.col("_run") >= F.col("from_run"))
                .withColumn(self.out, level + F.col("_ls") - F.least(F.lit(0).cast("bigint"), least))
                .select(*[F.col(f"`{c}`") for c in names], self.out))
