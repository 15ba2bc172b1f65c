"""Bronze → silver: parse, type, quality flags, valid/quarantine split, dedupe.

P1–P3, D1–D2, T3, F1–F2, T1–T2.  Every step is a narrow projection except the
dedupes (a shuffle on the dedupe key); `collapse_copies` optionally pre-aggregates
repeated events inside each task before the streaming dedupe shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecart.contracts import contract
from lakecart.functions.jsonfmt import parse_payload
from lakecart.functions.quality import error_list, is_late_expr, required_null_errors
from lakecart.functions.time import as_timestamp_literal, parse_event_time
from lakecart.operators.rows import keep_where
from lakecart.sources.bus import ENVELOPE_COLUMNS

QUALITY_COLUMNS = ["_dq_errors", "_dq_is_valid", "_dq_checked_at", "_dq_is_late"]


def parse_topic(envelope_df: DataFrame, topic: str, carry: Sequence[str] = ()) -> DataFrame:
    """Payload JSON → topic fields (schema declared, extras ignored, missing → null), then typed times.
    The envelope's columns and those of `carry` stay."""
    c = contract(topic)
    carried = [n for n in ENVELOPE_COLUMNS if n in envelope_df.columns] + list(carry)
    parsed = envelope_df.select(parse_payload("payload", c.schema).alias("_json"), *carried)
    typed = parsed.select("_json.*", *carried)
    return (typed.withColumn("event_ts", parse_event_time("event_ts"))
            .withColumn("ingestion_ts", parse_event_time("ingestion_ts")))


def add_quality(df: DataFrame, topic: str, checked_at: datetime | str | Column | None = None) -> DataFrame:
    """`_dq_errors` (ordered 'field:null' list), `_dq_is_valid` (never null), `_dq_checked_at`."""
    errors = error_list(required_null_errors(contract(topic)))
    return (df.withColumn("_dq_errors", errors)
            .withColumn("_dq_is_valid", F.size("_dq_errors") == 0)
            .withColumn("_dq_checked_at", as_timestamp_literal(checked_at)))


def add_late_flag(df: DataFrame, topic: str, now: datetime | str | Column | None = None) -> DataFrame:
    """`_dq_is_late`: event time strictly older than now − the topic's lateness."""
    c = contract(topic)
    return df.withColumn("_dq_is_late", is_late_expr(F.col(c.event_time), c.lateness_minutes, now))


def silver_frame(envelope_df: DataFrame, topic: str, now: datetime | str | Column | None = None,
                 carry: Sequence[str] = ()) -> DataFrame:
    """All parsed rows with quality columns; split with `valid_rows` / `quarantine_rows`."""
    return add_late_flag(add_quality(parse_topic(envelope_df, topic, carry), topic, now), topic, now)


def valid_rows(df: DataFrame) -> DataFrame:
    """Valid rows (F1).  See `keep_where` for why this is not a plain filter."""
    return keep_where(df, "_dq_is_valid")


def quarantine_rows(df: DataFrame) -> DataFrame:
    """Invalid rows (F2): the exact complement, since the flag is never null."""
    return keep_where(df.withColumn("_dq_is_invalid", ~F.col("_dq_is_valid")), "_dq_is_invalid") \
        .drop("_dq_is_invalid")


def dedupe_events(df: DataFrame, topic: str, tie_break: list[str] | None = None) -> DataFrame:
    """Batch dedupe on the topic key, keeping the first row by `tie_break` (default `event_id`,
    then bus partition and offset when present, so redeliveries of one event leave a fixed row).

    `row_number() == 1` plans as a per-partition top-1 before the shuffle
    (`WindowGroupLimit`), so a hot key ships at most one row per map task.
    """
    c = contract(topic)
    if tie_break is None:
        tie_break = ["event_id"] + [x for x in ("kafka_partition", "kafka_offset") if x in df.columns]
    order = [F.col(x).asc_nulls_last() for x in tie_break]
    w = Window.partitionBy(*c.dedupe_key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def stream_dedupe(df: DataFrame, topic: str) -> DataFrame:
    """Watermark on event time plus dedupe on the contract key (which includes event time),
    so dedupe state expires with the watermark.  Rows at or behind the watermark are dropped."""
    c = contract(topic)
    return df.withWatermark(c.event_time, c.watermark_delay).dropDuplicates(list(c.dedupe_key))


def packed_text(text: Column) -> Column:
    """Text as bytes, those of lower-case hexadecimal digits (fingerprints) in half; shuffles do not find that half."""
    raw = F.unhex(text)
    return F.when(F.lower(F.hex(raw)) == text, F.concat(F.lit(b"\x01"), raw)).otherwise(
        F.concat(F.lit(b"\x00"), text.cast("binary")))


def unpacked_text(packed: Column) -> Column:
    """The text of `packed_text`, byte for byte."""
    rest = F.substr(packed, F.lit(2))
    return F.when(F.substr(packed, F.lit(1), F.lit(1)) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def records_behind(valid: DataFrame, topic: str, more: Sequence[str] = ()) -> DataFrame:
    """Of silver rows only the dedupe key and the envelope: all that a dedupe has to move, as the payload tells the rest.
    The bus key is packed (`packed_text`).  `more`: further fields to go by."""
    c = contract(topic)
    envelope = [n for n in ENVELOPE_COLUMNS if n in valid.columns]
    return valid.select(*c.dedupe_key, *more, *[packed_text(F.col(n)).alias(n) if n == "kafka_key" else n for n in envelope])


def parsed_again(records: DataFrame, topic: str, now: datetime | str | Column | None = None,
                 carry: Sequence[str] = ()) -> DataFrame:
    """The silver rows of `records_behind`, parsed anew on the near side of the shuffle, with the columns of `carry`."""
    rows = records.drop(*contract(topic).dedupe_key)
    if "kafka_key" in rows.columns:
        rows = rows.withColumn("kafka_key", unpacked_text(F.col("kafka_key")))
    return silver_frame(rows, topic, now, carry)


def collapse_copies(df: DataFrame, topic: str) -> DataFrame:
    """Keep one row per dedupe key within each Arrow batch of each task (stateless).

    A pre-aggregation before the dedupe shuffle: a storm of copies of one event is
    collapsed map-side, so the state-store task for that key receives one row per
    input batch instead of every copy.  The stateful dedupe still decides across
    batches and triggers; which copy survives is arbitrary, as in any streaming dedupe.
    """
    keys = list(contract(topic).dedupe_key)

    def first_per_key(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows < 2:
                yield batch
                continue
            t = pa.Table.from_batches([batch])
            t = t.append_column("_row", pa.array(range(t.num_rows), type=pa.int64()))
            first = t.group_by(keys, use_threads=False).aggregate([("_row", "min")])["_row_min"]
            yield from t.take(first).drop_columns(["_row"]).to_batches()

    return df.mapInArrow(first_per_key, df.schema)
