"""Column-expression builders (scalars X1–X14).  Each returns a `Column`; none is a UDF."""

from lakecart.functions.fingerprint import fingerprint, json_literal
from lakecart.functions.jsonfmt import canonical_json, parse_payload
from lakecart.functions.money import round_money
from lakecart.functions.quality import error_list, is_late_expr, required_null_errors
from lakecart.functions.time import as_timestamp_literal, iso_utc_text, minutes_before, parse_event_time

__all__ = [
    "fingerprint", "json_literal", "canonical_json", "parse_payload", "round_money", "error_list",
    "is_late_expr", "required_null_errors", "as_timestamp_literal", "iso_utc_text",
    "minutes_before", "parse_event_time",
]
