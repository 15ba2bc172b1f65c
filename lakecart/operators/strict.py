"""Strict pre-publish checks on raw payloads.

These are a second, stricter dialect than the silver path (D1): the JSON kind of
each required field is checked, not just its presence after a typed parse.  For
example `"7"` for an int is `quantity:expected_int` here but `quantity:null` in
silver; `true` for an int is valid here (a bool is an int in the publishing
language) but null in silver.  Both dialects are kept on purpose.

Kinds come from `schema_of_variant` on the parsed payload:
string ← STRING; int ← integral, BOOLEAN, or a number beyond 64 bits whose text is
all digits; float ← the int kinds plus any DECIMAL, DOUBLE, FLOAT.  JSON null (VOID)
and an absent field are `field:null`.  A repeated key keeps its last value, as the
publishing side's JSON decoder does.  A payload that is not one JSON object
(malformed, truncated, an array, null) gets the single error `payload:not_an_object`.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecart.contracts import contract
from lakecart.functions.quality import error_list, is_late_expr
from lakecart.operators.rows import keep_where
from lakecart.functions.time import parse_iso_time
from lakecart.sinks.writers import publish_frame

_INTEGRAL = ["TINYINT", "SMALLINT", "INT", "BIGINT", "BOOLEAN"]
_NOT_OBJECT = "payload:not_an_object"
_CORRUPT = "_corrupt_payload"


def _with_kinds(df: DataFrame, topic: str, payload: str, extra_fields: list[str] | None = None) -> DataFrame:
    """Parse the payload once; record the JSON kind of each checked field as a column.

    `from_json` with VARIANT-typed fields is one streaming parse per row and keeps
    each value's own JSON kind; malformed text lands in the corrupt-record field.
    """
    c = contract(topic)
    names = list(dict.fromkeys([*c.required_names, c.event_time, *(extra_fields or [])]))
    schema = T.StructType([T.StructField(n, T.VariantType()) for n in names] +
                          [T.StructField(_CORRUPT, T.StringType())])
    j = F.from_json(F.col(payload), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    checked = list(dict.fromkeys([*c.required_names, c.event_time]))
    kinds = [F.schema_of_variant(F.col(f"_j.{n}")).alias(f"_k_{n}") for n in checked]
    is_object = F.col("_j").isNotNull() & F.col(f"_j.{_CORRUPT}").isNull()
    return (df.withColumn("_j", j)
            .select("*", is_object.alias("_obj_"), *kinds,
                    F.try_variant_get(F.col(f"_j.{c.event_time}"), "$", "string").alias("_t_")))


def _drop_kinds(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c in ("_j", "_t_", "_obj_") or c.startswith("_k_")])


def _is_big_int(kind: Column, name: str, payload: str) -> Column:
    """An integer literal beyond 64 bits.  Its kind alone does not tell (`12345678901234567890.0` is DECIMAL(20,0) too,
    over 38 digits are a DOUBLE), so the number's own text is read, for these rare kinds only."""
    wide = (kind == "DOUBLE") | kind.rlike(r"^DECIMAL\((19|[23][0-9]),0\)$")
    text = F.from_json(F.col(payload), T.StructType([T.StructField(name, T.StringType())]))[name]
    return F.when(wide, text.rlike("^-?[0-9]+$")).otherwise(False)


def _kind_ok(kind: Column, expected: str, name: str, payload: str) -> Column:
    # cheapest tests first: OR stops at the first true, so the text is read only for rare kinds
    if expected == "string":
        return kind == "STRING"
    if expected == "int":
        return kind.isin(_INTEGRAL) | _is_big_int(kind, name, payload)
    return kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL(") | kind.isin(_INTEGRAL)


def _time_text(topic: str) -> Column:
    """The event time when it is JSON text, else null."""
    c = contract(topic)
    return F.when(F.col(f"_k_{c.event_time}") == "STRING", F.col("_t_"))


def _time_text_error(topic: str) -> Column:
    """A non-empty text time that does not parse; other kinds are reported by the type check."""
    c = contract(topic)
    text = _time_text(topic)
    bad = (text != "") & parse_iso_time(text).isNull()
    return F.when(bad, F.lit(f"{c.event_time}:invalid_timestamp"))


def _strict_errors(topic: str, payload: str) -> Column:
    c = contract(topic)
    parts = []
    for name, expected in c.required:
        kind = F.col(f"_k_{name}")
        parts.append(F.when(kind.isNull() | (kind == "VOID"), F.lit(f"{name}:null"))
                     .when(~_kind_ok(kind, expected, name, payload), F.lit(f"{name}:expected_{expected}")))
    parts.append(_time_text_error(topic))
    return F.when(F.col("_obj_"), error_list(parts)).otherwise(F.array(F.lit(_NOT_OBJECT)))


def check_events(df: DataFrame, topic: str, payload: str = "payload") -> DataFrame:
    """Adds `_strict_errors` (ordered; per required field `field:null` / `field:expected_<kind>`,
    then the time check) and `_strict_is_valid` (D3 + D4)."""
    out = (_with_kinds(df, topic, payload)
           .withColumn("_strict_errors", _strict_errors(topic, payload))
           .withColumn("_strict_is_valid", F.size("_strict_errors") == 0))
    return _drop_kinds(out)


def timestamp_errors(df: DataFrame, topic: str, payload: str = "payload") -> DataFrame:
    """The event-time check alone (D4, D5): `_time_error` and the parsed UTC time `_event_time`."""
    out = (_with_kinds(df, topic, payload)
           .withColumn("_event_time", parse_iso_time(_time_text(topic)))
           .withColumn("_time_error", _time_text_error(topic)))
    return _drop_kinds(out)


def late_by_payload(df: DataFrame, topic: str, now: datetime | str | Column | None = None,
                    payload: str = "payload") -> DataFrame:
    """`_is_late` from the payload's own event time against `now`, strict (D6).  Unparsable → null."""
    c = contract(topic)
    out = _with_kinds(df, topic, payload).withColumn(
        "_is_late", is_late_expr(parse_iso_time(_time_text(topic)), c.lateness_minutes, now))
    return _drop_kinds(out)


def _quoted(text: Column) -> Column:
    # texts with nothing to escape need no JSON writer, which costs far more than the test
    listed = F.to_json(F.array(text))
    return F.when(text.rlike(r"^[ !#-\[\]-~]*$"), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(
        F.substr(listed, F.lit(2), F.length(listed) - 2))


def _sorted_members(payload: Column) -> Column:
    """`sorted_json` of any object."""
    kinds = F.transform(F.map_entries(F.from_json(payload, "map<string,variant>")), lambda e: F.schema_of_variant(e["value"]))
    both = F.arrays_zip(F.map_entries(F.from_json(payload, "map<string,string>")).alias("e"), kinds.alias("kind"))
    members = F.array_sort(F.transform(both, lambda m, i: F.struct(
        m["e"]["key"].alias("key"), i.alias("i"), m["e"]["value"].alias("text"), m["kind"].alias("kind"))))

    # One fold over the sorted members (each parse runs once a row); `last` waits for a later value of its key.
    def add(a, m):
        value = F.when(m["kind"] == "STRING", _quoted(m["text"])).otherwise(F.coalesce(m["text"], F.lit("null")))
        done = F.when(a["key"].isNull() | (a["key"] == m["key"]), a["done"]).otherwise(F.concat(a["done"], a["last"], F.lit(",")))
        return F.struct(done.alias("done"), m["key"].alias("key"), F.concat(_quoted(m["key"]), F.lit(":"), value).alias("last"))

    start = F.struct(F.lit("").alias("done"), F.lit(None).cast("string").alias("key"), F.lit("").alias("last"))
    return F.aggregate(members, start, add, lambda a: F.concat(F.lit("{"), a["done"], a["last"], F.lit("}")))


# A member of a flat object that needs no parser: a plain key, and a text without escapes, a number, true, false or null.
_PLAIN_KEY, _PLAIN_TEXT, _FLOAT = r'"([A-Za-z0-9_]++)":', r'"[ !#-\[\]-~]*+"', r"-?[0-9]++\.[0-9]++(?:E-?[0-9]++)?"
_PLAIN_MEMBER = rf"{_PLAIN_KEY}(?:{_PLAIN_TEXT}|{_FLOAT}|0|-?[1-9][0-9]*+|true|false|null)"


def sorted_json(payload: Column) -> Column:
    """A JSON object's text with its keys sorted and each value as the JSON parser writes it (strings re-escaped).

    A repeated key keeps its last value.  A flat object whose plain members, joined again, give its own text is sorted by
    member, since a plain key ends before any longer one that begins with it; fractions must be as doubles are written.
    All others go through the parser.
    """
    members, keys, floats = (F.regexp_extract_all(payload, F.lit(p), F.lit(i)) for p, i in (
        (_PLAIN_MEMBER, 0), (_PLAIN_MEMBER, 1), (f'":({_FLOAT})', 1)))
    joined = F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))
    distinct = F.size(F.array_distinct(keys)) == F.size(members)
    as_written = floats.cast("array<double>").cast("array<string>") == floats
    in_order = F.concat(F.lit("{"), F.array_join(F.sort_array(members), ","), F.lit("}"))
    return F.when((joined == payload) & distinct & as_written, in_order).otherwise(_sorted_members(payload))


def publish_gate(envelope_df: DataFrame, topic: str, num_partitions: int | None = None,
                 payload: str = "payload") -> DataFrame:
    """Drop events failing the strict checks; key the rest by the primary-key fingerprint and
    publish them whole, as sorted-key JSON (D8 → K5).  Returns bus records.

    Every field of the event is kept, the topic's or not, absent ones stay absent, and numbers stay as written.
    """
    c = contract(topic)
    parsed = _with_kinds(envelope_df, topic, payload, list(c.primary_key))
    checked = parsed.withColumn("_strict_errors", _strict_errors(topic, payload)) \
        .withColumn("_strict_is_valid", F.size("_strict_errors") == 0)
    valid = keep_where(checked.select("_j", F.col(payload).alias("_text"), "_strict_is_valid", "kafka_timestamp"),
                       "_strict_is_valid")
    value = sorted_json(F.col("_text"))
    keyed = valid.select(*[F.try_variant_get(F.col(f"_j.{k}"), "$", "string").alias(k) for k in c.primary_key],
                         value.alias("_value"), "kafka_timestamp")
    return publish_frame(keyed, topic, list(c.primary_key), value=F.col("_value"), num_partitions=num_partitions,
                         timestamp=F.col("kafka_timestamp"))
