"""Per-topic event contracts: one registry drives every schema and quality operator.

A contract names the topic's fields and types, the fields a valid event must carry,
the key that identifies a repeated delivery, the event-time column and how late an
event may arrive.  Operators read the registry when a plan is *built*; nothing here
touches data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's contracts for equal results.
# Field lists per topic (name, Spark type), in wire order.
# Required fields in check order (order = order of the error list), with the
# expected JSON kind: "string", "int" or "float" (float also accepts ints).
# Dedupe keys, event-time column and allowed lateness in minutes.
# ---------------------------------------------------------------------------
_COMMON = [("event_id", "string"), ("event_type", "string"), ("event_ts", "string"), ("ingestion_ts", "string")]

_FIELDS = {
    "orders": _COMMON + [
        ("order_id", "string"), ("user_id", "string"), ("product_id", "string"), ("sku", "string"),
        ("store_id", "string"), ("channel", "string"), ("quantity", "int"), ("unit_price", "double"),
        ("order_total", "double"), ("currency", "string"), ("status", "string"),
    ],
    "inventory": _COMMON + [
        ("product_id", "string"), ("sku", "string"), ("store_id", "string"), ("on_hand", "int"),
        ("available_to_promise", "int"), ("reorder_point", "int"), ("change_quantity", "int"),
        ("reason", "string"),
    ],
    "pricing": _COMMON + [
        ("product_id", "string"), ("sku", "string"), ("old_price", "double"), ("new_price", "double"),
        ("currency", "string"), ("reason", "string"),
    ],
    "clickstream": _COMMON + [
        ("session_id", "string"), ("user_id", "string"), ("product_id", "string"), ("sku", "string"),
        ("page", "string"), ("search_term", "string"), ("device", "string"), ("referrer", "string"),
    ],
}

_REQUIRED = {
    "orders": [
        ("event_id", "string"), ("event_type", "string"), ("event_ts", "string"), ("order_id", "string"),
        ("user_id", "string"), ("product_id", "string"), ("store_id", "string"), ("quantity", "int"),
        ("unit_price", "float"), ("order_total", "float"),
    ],
    "inventory": [
        ("event_id", "string"), ("event_type", "string"), ("event_ts", "string"), ("product_id", "string"),
        ("store_id", "string"), ("on_hand", "int"), ("available_to_promise", "int"), ("reorder_point", "int"),
    ],
    "pricing": [
        ("event_id", "string"), ("event_type", "string"), ("event_ts", "string"), ("product_id", "string"),
        ("old_price", "float"), ("new_price", "float"),
    ],
    "clickstream": [
        ("event_id", "string"), ("event_type", "string"), ("event_ts", "string"), ("session_id", "string"),
        ("user_id", "string"), ("page", "string"), ("device", "string"),
    ],
}

_DEDUPE_KEY = {
    "orders": ["order_id", "product_id", "event_ts"],
    "inventory": ["product_id", "store_id", "event_ts"],
    "pricing": ["product_id", "event_ts"],
    "clickstream": ["session_id", "event_type", "event_ts"],
}

_LATENESS_MINUTES = {"orders": 120, "inventory": 180, "pricing": 240, "clickstream": 60}

_PRIMARY_KEY = ["event_id"]
_EVENT_TIME = "event_ts"
# ---------------------------------------------------------------------------

_SPARK_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType()}
_KINDS = {"string", "int", "float"}


@dataclass(frozen=True)
class Contract:
    topic: str
    fields: tuple[tuple[str, str], ...]
    required: tuple[tuple[str, str], ...]
    dedupe_key: tuple[str, ...]
    lateness_minutes: int
    primary_key: tuple[str, ...] = field(default=tuple(_PRIMARY_KEY))
    event_time: str = _EVENT_TIME

    @property
    def field_names(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def required_names(self) -> list[str]:
        return [name for name, _ in self.required]

    @property
    def schema(self) -> T.StructType:
        """Wire schema of the payload: every field nullable, times still text."""
        return T.StructType([T.StructField(n, _SPARK_TYPES[t], True) for n, t in self.fields])

    @property
    def watermark_delay(self) -> str:
        return f"{self.lateness_minutes} minutes"

    def validate(self) -> None:
        names = set(self.field_names)
        for name, kind in self.required:
            if name not in names:
                raise ValueError(f"{self.topic}: required field {name!r} is not in the schema")
            if kind not in _KINDS:
                raise ValueError(f"{self.topic}: unknown kind {kind!r} for {name!r}")
        for name in [*self.dedupe_key, *self.primary_key, self.event_time]:
            if name not in names:
                raise ValueError(f"{self.topic}: key field {name!r} is not in the schema")
        if self.lateness_minutes <= 0:
            raise ValueError(f"{self.topic}: lateness must be positive")


def _build() -> dict[str, Contract]:
    out = {}
    for topic, fields in _FIELDS.items():
        c = Contract(
            topic=topic,
            fields=tuple(fields),
            required=tuple(_REQUIRED[topic]),
            dedupe_key=tuple(_DEDUPE_KEY[topic]),
            lateness_minutes=_LATENESS_MINUTES[topic],
        )
        c.validate()
        out[topic] = c
    return out


CONTRACTS: dict[str, Contract] = _build()
TOPICS: tuple[str, ...] = tuple(CONTRACTS)


def contract(topic: str) -> Contract:
    try:
        return CONTRACTS[topic]
    except KeyError:
        raise ValueError(f"unknown topic {topic!r}; known: {', '.join(TOPICS)}") from None


def select_topics(spec: str | None) -> list[str]:
    """Comma-separated topic list, blanks dropped, each checked against the registry."""
    if spec is None:
        return list(TOPICS)
    topics = [t.strip() for t in spec.split(",") if t.strip()]
    for t in topics:
        contract(t)
    return topics
