"""Quality scalars: required-field checks and the late flag."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakecart.contracts import Contract
from lakecart.functions.time import as_timestamp_literal, minutes_before

_SEP = ","


def required_null_errors(contract: Contract) -> list[Column]:
    """One nullable text per required field, in contract order: 'field:null' or null."""
    return [F.when(F.col(n).isNull(), F.lit(f"{n}:null")) for n in contract.required_names]


def error_list(parts: list[Column]) -> Column:
    """Ordered array of the non-null messages; empty array when all pass.

    Built as `concat_ws` (skips nulls) then `split`, which stays in generated code;
    a lambda `filter` would evaluate every message expression interpreted.
    Messages never contain the separator.
    """
    joined = F.concat_ws(_SEP, *parts)
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, _SEP))


def is_late_expr(event_time: Column, lateness_minutes: int, now: datetime | str | Column | None = None) -> Column:
    """Strictly older than now − lateness; null time gives a null flag."""
    return event_time < minutes_before(as_timestamp_literal(now), lateness_minutes)
