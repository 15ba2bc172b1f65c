import hashlib
import json
from datetime import UTC, datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from lakecart.functions.fingerprint import fingerprint
from lakecart.functions.quality import is_late_expr
from lakecart.functions.time import iso_utc_text, parse_event_time, parse_iso_time


def test_event_time_parsing(spark):
    cases = {
        "2026-05-02T12:00:00+02:00": datetime(2026, 5, 2, 10, 0),
        "2026-05-02T12:00:00Z": datetime(2026, 5, 2, 12, 0),
        "2026-05-02 12:00:00": datetime(2026, 5, 2, 12, 0),           # zone-less = UTC
        "2026-05-02T20:24:41.876582Z": datetime(2026, 5, 2, 20, 24, 41, 876582),
        "2026-13-02T00:00:00Z": None,
        "12:30": None,                                                  # no date: not "today"
        "2026": None,
        "": None,
        "not-a-time": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.t for r in df.select("s", parse_event_time("s").cast("timestamp_ntz").alias("t")).collect()}
    assert got == cases


def test_iso_text_round_trip(spark):
    df = spark.createDataFrame([("2026-05-02T20:24:41.876582Z",), ("2026-05-02T00:00:00Z",)], "s string")
    out = [r[0] for r in df.select(iso_utc_text(parse_event_time("s"))).collect()]
    assert out == ["2026-05-02T20:24:41.876582Z", "2026-05-02T00:00:00.000000Z"]


def test_late_flag_is_strict(spark):
    now = datetime(2026, 5, 2, 12, 0, tzinfo=UTC)
    times = [now - timedelta(minutes=m) for m in (181, 180, 10)]
    df = spark.createDataFrame([(t.strftime("%Y-%m-%dT%H:%M:%SZ"),) for t in times] + [(None,)], "s string")
    flags = [r[0] for r in df.select(is_late_expr(parse_event_time("s"), 180, now)).collect()]
    assert flags == [True, False, False, None]


def _python_fingerprint(event, keys):
    payload = {k: event.get(k) for k in keys}
    return hashlib.sha256(json.dumps(payload, sort_keys=True, default=str).encode()).hexdigest()


def test_fingerprint_matches_python_form(spark):
    ev = {"order_id": "basket-9", "product_id": "K10", "event_ts": "2026-04-11T08:30:00Z", "ignored": "a"}
    df = spark.createDataFrame([ev, {**ev, "ignored": "b"}])
    keys = ["order_id", "product_id", "event_ts"]
    got = [r[0] for r in df.select(fingerprint(df, keys)).collect()]
    assert got[0] == got[1] == _python_fingerprint(ev, keys)
    # a missing key counts as null
    assert df.select(fingerprint(df, ["order_id", "absent"])).first()[0] == \
        _python_fingerprint(ev, ["order_id", "absent"])


printable = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=126), max_size=12)


@settings(max_examples=25, deadline=None)
@given(a=st.one_of(st.none(), printable), b=st.one_of(st.none(), printable), n=st.integers(-10**12, 10**12))
def test_fingerprint_property(spark, a, b, n):
    df = spark.createDataFrame([(a, b, n)], "a string, b string, n bigint")
    assert df.select(fingerprint(df, ["b", "a", "n"])).first()[0] == \
        _python_fingerprint({"a": a, "b": b, "n": n}, ["b", "a", "n"])


ISO_TEXTS = [
    "20260502T120000Z", "2026-W18-6", "2026W186", "2026-W18", "2026-W53-1", "2020-W53-7", "2026-W00-1", "2026-W18-8",
    "2026-05-02T12:00:00,123Z", "2026-05-02 12:00:00 America/New_York", "2026-05-02 12:00:00 UTC", "2026-05-02",
    "2026-05-02T", "2026-05-02T12", "2026-05-02T1200", "2026-05-02T120000.5", "2026-05-02T12:00:00.1234567",
    "2026-05-02x12:00", "2026-05-02T24:00:00", "2026-05-02T12:60:00", "2026-05-02T12:00:60", "2026-05-02T12:00+23:59",
    "2026-05-02T12:00:00-18:30", "2026-05-02T12:00:00+24:00", "2026-05-02T12:00+0530", "2026-05-02T12+05:30:15.5",
    "2026-02-30", "2026-13-01", "0000-01-01", "12:30", "2026", "", "not-a-time", "1969-12-31T23:59:59.999999Z",
    "20240229 235959,999999-0001", "2026-5-2", " 2026-05-02", "2026-05-02T12:00:00z",
]


def _python_time(text):
    try:
        t = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    return (t if t.tzinfo is None else t.astimezone(UTC)).replace(tzinfo=None)


def test_iso_time_reads_what_python_reads(spark):
    df = spark.createDataFrame([(t,) for t in ISO_TEXTS] + [(None,)], "s string")
    got = {r.s: r.t for r in df.select("s", parse_iso_time("s").cast("timestamp_ntz").alias("t")).collect()}
    assert got == {t: _python_time(t) for t in ISO_TEXTS} | {None: None}


def test_fingerprint_of_other_types_and_escapes(spark):
    from datetime import date
    from decimal import Decimal

    texts = ["a\nb", "é", "\x00\x7f\t\r\b\f", "\U0001f600x", 'q"\\é', "", None, "plain"]
    doubles = [12345678.5, 1e16, 1e-5, 0.001, 0.0001, -1e7, 0.0, None]
    rows = [{"a": a, "x": x, "d": date(2024, 1, 2), "t": datetime(2024, 1, 2, 3, 4, 5, i * 100, tzinfo=UTC),
             "m": Decimal("1.50")} for i, (a, x) in enumerate(zip(texts, doubles, strict=True))]
    df = spark.createDataFrame([tuple(r.values()) for r in rows],
                               "a string, x double, d date, t timestamp, m decimal(10,2)")
    keys = list(rows[0])
    assert [r[0] for r in df.select(fingerprint(df, keys)).collect()] == [_python_fingerprint(r, keys) for r in rows]
