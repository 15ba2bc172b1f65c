"""Inventory gold: latest state per product × store, risk level, alerts, stock ledger.

W1, W2, P10, P11, F4, F5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

INVENTORY_KEY = ["product_id", "store_id"]
RISK_MODEL_COLUMNS = ["product_id", "sku", "store_id", "event_ts", "on_hand", "available_to_promise",
                      "reorder_point", "inventory_risk_level"]
ALERT_REPORT_COLUMNS = ["product_id", "store_id", "available_to_promise", "reorder_point", "inventory_risk_level"]

# Risk level names.
STOCKOUT, REORDER, HEALTHY = "stockout", "reorder", "healthy"
RISK_LEVELS = (STOCKOUT, REORDER, HEALTHY)


def latest_state(df: DataFrame, keys: list[str] | None = None, time_col: str = "event_ts",
                 tie_break: list[str] | None = None) -> DataFrame:
    """Latest row per key by event time descending (W1 + F4).

    Ties on the time go to the largest `tie_break` (default `event_id`, then bus
    partition and offset when present), so the result is deterministic.  `row_number() == 1` is planned with a per-partition
    top-1 before the shuffle, so one hot key costs one row per map task.
    """
    keys = keys or INVENTORY_KEY
    if tie_break is None:   # event id, then the bus position when the rows carry it (silver does)
        tie_break = ["event_id"] + [c for c in ("kafka_partition", "kafka_offset") if c in df.columns]
    order = [F.col(time_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_break]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def risk_level(available: Column | str = "available_to_promise", reorder_point: Column | str = "reorder_point") -> Column:
    """≤ 0 stockout; ≤ reorder point reorder; otherwise (null included) healthy (P10)."""
    a = F.col(available) if isinstance(available, str) else available
    r = F.col(reorder_point) if isinstance(reorder_point, str) else reorder_point
    return F.when(a <= 0, F.lit(STOCKOUT)).when(a <= r, F.lit(REORDER)).otherwise(F.lit(HEALTHY))


def with_risk(df: DataFrame) -> DataFrame:
    """Adds `is_low_inventory` (P11) and `inventory_risk_level` (P10)."""
    return (df.withColumn("is_low_inventory", F.col("available_to_promise") <= F.col("reorder_point"))
            .withColumn("inventory_risk_level", risk_level()))


def inventory_gold(silver_inventory: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Latest state with the risk columns: every input column kept."""
    return with_risk(latest_state(silver_inventory, tie_break=tie_break))


def inventory_alerts(gold: DataFrame) -> DataFrame:
    """Non-healthy rows only (F5): the batch job's alert table."""
    return gold.filter(F.col("inventory_risk_level") != HEALTHY)


def inventory_risk_model(staged_inventory: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """The SQL model's shape: all levels, 8 columns."""
    return latest_state(staged_inventory, tie_break=tie_break) \
        .withColumn("inventory_risk_level", risk_level()).select(*RISK_MODEL_COLUMNS)


def time_bucket(df: DataFrame, name: str, width: int) -> Column:
    """Number of the `width`-wide bucket of an order column (seconds for times and dates, units for numbers).

    Computed from the row alone; nulls come first.
    """
    dtype, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(c.cast("timestamp")) / 1_000_000
    elif isinstance(dtype, T.DateType):
        value = F.unix_date(c).cast("bigint") * 86_400
    elif isinstance(dtype, T.NumericType):
        value = c
    else:
        raise TypeError(f"the first order column must be a time, a date or a number, not {dtype.simpleString()}")
    return F.coalesce(F.floor(value / width).cast("bigint"), F.lit(-(2 ** 63)))


def plain_key(df: DataFrame, name: str) -> list[Column]:
    """A key as two columns without nulls, so that plain equality joins null keys too."""
    dtype, c = df.schema[name].dataType, F.col(f"`{name}`")
    zero = F.lit("" if isinstance(dtype, T.StringType) else "1970-01-01" if isinstance(
        dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)) else 0).cast(dtype)
    return [c.isNull(), F.coalesce(c, zero)]


def stock_ledger(df: DataFrame, delta: str = "change_quantity", initial: int | str = 0,
                 keys: list[str] | None = None, order: list[str] | None = None,
                 bucket: int = 86_400, out: str = "ledger_on_hand",
                 total_order: bool = True) -> DataFrame:
    """Running stock floored at zero: on_hand_k = max(0, on_hand_{k-1} + delta_k) per key.

    Closed form: with S_k = initial + Σ_{i≤k} delta_i, on_hand_k = S_k − min(0, min_{j≤k} S_j).
    A plain window per key would put a hot key's whole history in one task, so each key's sequence is cut into
    buckets of its first order column (`bucket` seconds, or units of a number; a day by default; take less for
    hotter keys).  Per bucket the local running sum and minimum are window results (the one shuffle of full rows, on
    key + bucket); a per-(key, bucket) summary gives each bucket its offset and the minimum of all earlier ones and
    is joined back, moving only the summary.  No sample, count or broadcast is needed.  Null keys form a key of their
    own and keep their rows.  `initial` is an integer or a column constant per key; null deltas count 0.
    Rows that tie on `order` are ordered by a hash of the whole row, so the result is
    the same on every run (a sequential fold over tied rows has no single answer);
    with `total_order=False` (the caller's order is already unique) that hash is
    skipped and the summary pass reads only key, order and delta columns.
    """
    keys = keys or INVENTORY_KEY
    order = order or ["event_ts", "event_id"]
    init = F.lit(initial) if isinstance(initial, int) else F.col(initial)

    # a deterministic last tie-break makes the order total: rows equal in every column
    # are interchangeable in a running sum, all others are ordered the same way every run
    tb = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) if total_order else F.lit(0).cast("bigint")
    own = [f"_k{i}" for i in range(2 * len(keys))]
    plain = dict(zip(own, [c for k in keys for c in plain_key(df, k)], strict=True))
    rows = df.withColumns({**plain, "_seg": time_bucket(df, order[0], bucket), "_tb": tb,
                           "_d": F.coalesce(F.col(delta).cast("bigint"), F.lit(0)), "_init": init.cast("bigint")})
    order = [*order, "_tb"] if total_order else list(order)

    w_local = Window.partitionBy(*own, "_seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_ls", F.sum("_d").over(w_local)).withColumn("_lmin", F.min("_ls").over(w_local))

    w_prev = Window.partitionBy(*own).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    segs = (local.groupBy(*own, "_seg").agg(F.sum("_d").alias("_tot"), F.min("_ls").alias("_smin"))
            .withColumn("_off", F.coalesce(F.sum("_tot").over(w_prev), F.lit(0)))
            .withColumn("_pmin", F.min(F.col("_off") + F.col("_smin")).over(w_prev))
            .select(*own, "_seg", "_off", "_pmin"))

    s = F.col("_init") + F.col("_off") + F.col("_ls")
    # least() skips nulls: the first bucket has no earlier minimum
    running_min = F.least(F.col("_init") + F.col("_off") + F.col("_lmin"), F.col("_init") + F.col("_pmin"))
    return (local.join(segs, [*own, "_seg"], "inner")
            .withColumn(out, s - F.least(F.lit(0).cast("bigint"), running_min))
            .select(*[F.col(f"`{c}`") for c in df.columns if c != out], out))
