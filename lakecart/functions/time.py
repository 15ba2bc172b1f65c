"""Time scalars: text → timestamp, timestamp → ISO text, intervals."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakecart.functions._util import to_col

# An event time must start with a calendar date; Spark alone would read "12:30"
# as today 12:30 and "2026" as 1 January, which makes results depend on the run date.
DATE_PREFIX = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def parse_event_time(c: Column | str) -> Column:
    """ISO-8601 text → TIMESTAMP; 'Z', offsets and zone-less (session zone, UTC) forms.

    Never raises: unparsable or date-less text gives null, so one bad event cannot
    stop a stream under ANSI mode.
    """
    c = to_col(c)
    return F.when(c.rlike(DATE_PREFIX), F.try_to_timestamp(c))


# The usual spellings, read by Spark itself; anything else goes through `_any_iso_time`.
_COMMON_ISO = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?(Z|[+-](0[0-9]|1[0-7]):[0-5][0-9])?$"
_CLOCK = r"[0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?|[0-9]{2}(?:[0-9]{2}(?:[.,][0-9]+)?)?)?"
_ISO = (r"(?s)^((?!0000)[0-9]{4}(?:-[0-9]{2}-[0-9]{2}|[0-9]{4}|-W[0-9]{2}(?:-[0-9])?|W[0-9]{2}[0-9]?))"
        rf"(?:.({_CLOCK})(?:([+-])({_CLOCK}))?)?$")


def _clock_seconds(text: Column) -> Column:
    """'HH', 'HHMM', 'HH:MM:SS.f' … → seconds with six decimals; no text is midnight."""
    whole = F.rpad(F.regexp_replace(F.regexp_extract(text, r"^[0-9:]*", 0), ":", ""), 6, "0")
    part = F.rpad(F.substring(F.regexp_extract(text, r"[.,]([0-9]+)$", 1), 1, 6), 6, "0")
    at = lambda i: F.substring(whole, i, 2).cast("int")
    return (at(1) * 3600 + at(3) * 60 + at(5)).cast("decimal(18,6)") + part.cast("decimal(18,6)") / 1000000


def _any_iso_time(text: Column) -> Column:
    text = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    date, clock, sign, offset = (F.regexp_extract(text, _ISO, i) for i in range(1, 5))
    digits = F.regexp_replace(date, "-", "")
    year, week = F.substring(digits, 1, 4), F.substring(digits, 6, 2).try_cast("int")
    day = F.when(F.length(digits) == 8, F.substring(digits, 8, 1).try_cast("int")).otherwise(1)
    fourth = F.concat(year, F.lit("-01-04")).try_cast("date")
    monday = F.date_add(fourth, (week - 1) * 7 - F.weekday(fourth))
    by_week = F.when((F.weekofyear(monday) == week) & day.between(1, 7), F.date_add(monday, day - 1))
    by_month = F.concat_ws("-", year, F.substring(digits, 5, 2), F.substring(digits, 7, 2)).try_cast("date")
    whole = F.rpad(F.regexp_replace(F.regexp_extract(clock, r"^[0-9:]*", 0), ":", ""), 6, "0")
    in_range = (F.substring(whole, 1, 2) < "24") & (F.substring(whole, 3, 2) < "60") & (F.substring(whole, 5, 2) < "60")
    shift = _clock_seconds(offset) * F.when(sign == "-", -1).otherwise(1)
    start = F.unix_date(F.when(F.contains(digits, F.lit("W")), by_week).otherwise(by_month)).cast("bigint") * 86400
    micros = (start.cast("decimal(18,0)") + _clock_seconds(clock) - shift) * 1000000
    return F.when((date != "") & in_range & (F.abs(shift) < 86400), F.timestamp_micros(micros.cast("bigint")))


def parse_iso_time(c: Column | str) -> Column:
    """ISO-8601 text → TIMESTAMP as the publishing side reads it (strict dialect, D4/D5); never raises.

    Calendar dates (`2026-05-02`, `20260502`) and week dates (`2026-W18-6`, `2026W186`), any one character before the
    clock, clocks with or without colons and with a `.` or `,` fraction (cut at microseconds), `Z` or a numeric
    offset below a day; without one the time is UTC.  Zone names and anything else give null.
    """
    c = to_col(c)
    return F.when(c.rlike(_COMMON_ISO), F.try_to_timestamp(c)).when(~c.rlike(_COMMON_ISO), _any_iso_time(c))


def iso_utc_text(c: Column | str) -> Column:
    """Timestamp → 'yyyy-MM-ddTHH:mm:ss.ffffffZ' in UTC, whatever the session zone."""
    return F.date_format(F.to_utc_timestamp(to_col(c), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def as_timestamp_literal(value: datetime | str | Column | None) -> Column:
    """`now` for late tests.  None → current time; naive datetimes are UTC."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo is None:
            value = value.replace(tzinfo=UTC)
        value = value.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    return F.lit(value).cast("timestamp")


def minutes_before(ts: Column, minutes: int) -> Column:
    return ts - F.make_interval(mins=F.lit(int(minutes)))
