"""Event fingerprint: SHA-256 hex of the canonical JSON of chosen keys.

The text is built byte for byte like Python's ``json.dumps(obj, sort_keys=True, default=str)``:
``{"k1": v1, "k2": v2}`` with a space after ':' and ','; null as ``null``; integers and
booleans bare; doubles as Python prints them.  Strings are quoted, with '\\', '"', control and
non-ASCII characters escaped.  Dates, times and decimals are quoted as Python's ``str`` gives
them (a TIMESTAMP as its UTC time with ``+00:00``, a TIMESTAMP_NTZ without offset).  Doubles rest
on Java's digits, which before Java 19 are for some values one longer than the shortest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# JSON's short escapes of control characters.
_SHORT_ESCAPES = {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def _escaped_char(ch: Column) -> Column:
    units = F.lower(F.hex(F.encode(ch, "UTF-16BE")))
    out = F.when(ch.rlike("^[ -~]$"), ch)
    for raw, short in _SHORT_ESCAPES.items():
        out = out.when(ch == raw, F.lit(short))
    return out.otherwise(F.regexp_replace(units, "(.{4})", r"\\u$1"))


def _quoted(c: Column) -> Column:
    escaped = F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), '"', r'\\"')
    # character by character only where a text has something beyond printable ASCII
    rare = F.when(c.rlike(r"[^ -~]"), F.array_join(F.transform(F.split(escaped, ""), _escaped_char), ""))
    return F.concat(F.lit('"'), F.coalesce(rare, escaped), F.lit('"'))


def _double_text(c: Column) -> Column:
    """Java's text of a double, laid out as Python does: plain for 1e-4 ≤ |x| < 1e16, else with a signed exponent."""
    text = c.cast("string")
    form = r"^(-?)([0-9])\.([0-9]+)E(-?[0-9]+)$"
    sign, lead, rest = (F.regexp_extract(text, form, i) for i in (1, 2, 3))
    power = F.regexp_extract(text, form, 4).cast("int")
    tail = F.when(rest == "0", F.lit("")).otherwise(rest)
    digits, point = F.concat(lead, tail), power + 1
    size = F.length(digits)
    plain = (F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
             .when(size <= point, F.concat(digits, F.repeat(F.lit("0"), point - size), F.lit(".0")))
             .otherwise(F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1))))
    exponent = F.concat(F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
                        F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(power).cast("string"))
    scientific = F.concat(lead, F.when(tail == "", F.lit("")).otherwise(F.concat(F.lit("."), tail)), exponent)
    return F.when(~text.rlike("E"), text).otherwise(
        F.concat(sign, F.when((point > -4) & (point <= 16), plain).otherwise(scientific)))


def _time_text(ntz: Column, suffix: str) -> Column:
    whole, part = F.date_format(ntz, "yyyy-MM-dd HH:mm:ss"), F.date_format(ntz, ".SSSSSS")
    return F.concat(whole, F.when(part == ".000000", F.lit("")).otherwise(part), F.lit(suffix))


def json_literal(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        text = _quoted(c)
    elif isinstance(dtype, T.BooleanType):
        text = F.when(c, F.lit("true")).otherwise(F.lit("false"))
    elif isinstance(dtype, T.IntegralType):
        text = c.cast("string")
    elif isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        text = _double_text(c.cast("double"))
    elif isinstance(dtype, T.TimestampType):
        text = _quoted(_time_text(F.to_utc_timestamp(c, F.current_timezone()), "+00:00"))
    elif isinstance(dtype, T.TimestampNTZType):
        text = _quoted(_time_text(c, ""))
    else:
        text = _quoted(c.cast("string"))
    return F.when(c.isNull(), F.lit("null")).otherwise(text)


def fingerprint(df: DataFrame, keys: list[str]) -> Column:
    """Column with the hex SHA-256 of the keys' canonical JSON; missing keys count as null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for k in sorted(keys):
        value = json_literal(F.col(k), types[k]) if k in types else F.lit("null")
        parts.append(F.concat(F.lit(f'"{k}": '), value))
    text = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    return F.sha2(text, 256)
