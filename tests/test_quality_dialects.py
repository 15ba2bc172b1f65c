"""The silver check (D1, permissive typed parse) and the strict publish check
disagree on purpose; one assertion per edge row."""

import json

import pytest

from helpers import envelope, order
from lakecart.contracts import contract
from lakecart.operators import silver, strict

ALL_NULL = ",".join(f"{n}:null" for n in contract("orders").required_names)


def _o(**over):
    return json.dumps(order(**over))


def _raw(text_fields: str) -> str:
    base = order()
    return json.dumps(base)[:-1] + ", " + text_fields + "}"


EDGE = [
    # name, payload, silver errors, strict errors
    ("valid", _o(), "", ""),
    ("not json", "not json", ALL_NULL, "payload:not_an_object"),
    ("null payload", None, ALL_NULL, "payload:not_an_object"),
    ("array", "[1]", ALL_NULL, "payload:not_an_object"),
    ("empty object", "{}", ALL_NULL, ALL_NULL),
    ("int as text", _o(quantity="7"), "quantity:null", "quantity:expected_int"),
    ("fraction for int", _o(quantity=1.5), "quantity:null", "quantity:expected_int"),
    ("1.0 for int", _o(quantity=1.0), "quantity:null", "quantity:expected_int"),
    ("bool for int", _o(quantity=True), "quantity:null", ""),
    ("number for text", _o(user_id=5), "", "user_id:expected_string"),
    ("object for text", _o(user_id={"k": 1}), "", "user_id:expected_string"),
    ("too large int", _o(quantity=99999999999), "quantity:null", ""),
    ("45-digit int", _o(quantity=int("1" * 45)), "quantity:null", ""),
    ("long whole float for int", _o().replace('"quantity": 3,', '"quantity": 12345678901234567890.0,'), "quantity:null", "quantity:expected_int"),
    ("exponent for int", _o().replace('"quantity": 3,', '"quantity": 1e5,'), "quantity:null", "quantity:expected_int"),
    ("basic time", _o(event_ts="20260502T120000Z"), "event_ts:null", ""),
    ("week time", _o(event_ts="2026-W18-6"), "event_ts:null", ""),
    ("comma fraction", _o(event_ts="2026-05-02T12:00:00,123Z"), "event_ts:null", ""),
    ("zone name", _o(event_ts="2026-05-02 12:00:00 America/New_York"), "", "event_ts:invalid_timestamp"),
    ("int for float", _o(unit_price=10), "", ""),
    ("json null", _o(order_id=None), "order_id:null", "order_id:null"),
    ("empty time", _o(event_ts=""), "event_ts:null", ""),
    ("bare clock time", _o(event_ts="12:30"), "event_ts:null", "event_ts:invalid_timestamp"),
    ("month 13", _o(event_ts="2026-13-02T00:00:00Z"), "event_ts:null", "event_ts:invalid_timestamp"),
    ("number time", _o(event_ts=5), "event_ts:null", "event_ts:expected_string"),
    ("offset time", _o(event_ts="2026-05-02T12:00:00+02:00"), "", ""),
    ("zone-less time", _o(event_ts="2026-05-02T12:00:00"), "", ""),
    ("trailing junk", _o() + "junk", "", ""),
    ("extra field", _o(extra_field=1), "", ""),
    ("cut early", _o()[:15], ALL_NULL, "payload:not_an_object"),
    ("cut late", _o()[:-5], ALL_NULL, "payload:not_an_object"),
]


@pytest.fixture(scope="module")
def checked(spark):
    env = envelope(spark, "orders", [e[1] for e in EDGE])
    sil = silver.silver_frame(env, "orders")
    s = {r.kafka_offset: (",".join(r._dq_errors), r._dq_is_valid, r.event_ts, r.user_id)
         for r in sil.select("kafka_offset", "_dq_errors", "_dq_is_valid", "event_ts", "user_id").collect()}
    st = {r.kafka_offset: ",".join(r._strict_errors)
          for r in strict.check_events(env, "orders").select("kafka_offset", "_strict_errors").collect()}
    return s, st


@pytest.mark.parametrize("i", range(len(EDGE)), ids=[e[0] for e in EDGE])
def test_edge_row(checked, i):
    s, st = checked
    name, _payload, want_silver, want_strict = EDGE[i]
    assert s[i][0] == want_silver, name
    assert s[i][1] == (want_silver == ""), name
    assert st[i] == want_strict, name


def test_times_normalised_to_utc(checked):
    s, _ = checked
    by_name = {e[0]: s[i] for i, e in enumerate(EDGE)}
    assert by_name["offset time"][2].strftime("%H:%M") == "10:00"
    assert by_name["zone-less time"][2].strftime("%H:%M") == "12:00"
    assert by_name["number for text"][3] == "5"                      # silver stringifies


def test_duplicate_key_last_wins(spark):
    payload = _o()[:-1] + ', "order_id": "LAST"}'
    env = envelope(spark, "orders", [payload])
    assert strict.check_events(env, "orders").first()._strict_is_valid
    assert silver.parse_topic(env, "orders").first().order_id == "LAST"


def test_valid_and_quarantine_partition_the_input(spark):
    env = envelope(spark, "orders", [e[1] for e in EDGE])
    sil = silver.silver_frame(env, "orders")
    valid = {r.kafka_offset for r in silver.valid_rows(sil).select("kafka_offset").collect()}
    bad = {r.kafka_offset for r in silver.quarantine_rows(sil).select("kafka_offset").collect()}
    assert valid.isdisjoint(bad) and valid | bad == set(range(len(EDGE)))


def test_publish_gate_keeps_valid_events_with_their_json_kinds(spark):
    import hashlib

    from lakecart.operators.strict import publish_gate
    env = envelope(spark, "orders", [_o(quantity=True, event_id="keep"), _o(quantity="7", event_id="drop"),
                                     "not json"])
    out = publish_gate(env, "orders").collect()
    assert len(out) == 1
    rec = out[0]
    assert rec.key.decode() == hashlib.sha256(json.dumps({"event_id": "keep"}, sort_keys=True).encode()).hexdigest()
    value = json.loads(rec.value.decode())
    assert value["quantity"] is True and value["event_id"] == "keep"
    assert list(value) == sorted(value)


def test_published_value_is_the_whole_event(spark):
    event = json.loads(_o(event_id="keep", coupon="first", note="X\"10\n", nested={"b": [1, {"c": None}], "a": 1.50}, none=None, unit_price=10.0))
    event.pop("sku")
    rec = strict.publish_gate(envelope(spark, "orders", [json.dumps(event)[:-1] + ', "coupon": "last"}']), "orders").first()
    text = rec.value.decode()
    assert json.loads(text) == event | {"coupon": "last"}
    assert '"unit_price":10.0' in text and '"sku"' not in text and list(json.loads(text)) == sorted(event)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_REQ = contract("orders").required_names


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(list(order())), st.sampled_from(["drop", "null"])), max_size=6))
def test_missing_fields_reported_in_contract_order(spark, edits):
    ev = order()
    for field, how in edits:
        if how == "drop":
            ev.pop(field, None)
        else:
            ev[field] = None
    want = [f"{n}:null" for n in _REQ if ev.get(n) is None]
    env = envelope(spark, "orders", [json.dumps(ev)])
    row = silver.silver_frame(env, "orders").first()
    assert list(row._dq_errors) == want and row._dq_is_valid == (not want)
    assert list(strict.check_events(env, "orders").first()._strict_errors) == want


# One invented event per topic (orders: the helpers' own).
SAMPLE_BY_TOPIC = {
    "orders": order(),
    "inventory": {"event_id": "i1", "event_type": "inventory_update", "event_ts": "2026-04-11T09:14:02.250000Z",
                  "ingestion_ts": "2026-04-11T09:14:05.000001Z", "product_id": "K11", "sku": "lamp-brass",
                  "store_id": "oslo-2", "on_hand": 31, "available_to_promise": 30, "reorder_point": 12,
                  "change_quantity": 6, "reason": "delivery"},
    "pricing": {"event_id": "p1", "event_type": "price_change", "event_ts": "2026-04-11T10:00:00.500000Z",
                "ingestion_ts": "2026-04-11T10:00:01.750000Z", "product_id": "K14", "sku": "chair-ash",
                "old_price": 205.25, "new_price": 210.0, "currency": "NOK", "reason": "season"},
    "clickstream": {"event_id": "c1", "event_type": "search", "event_ts": "2026-04-11T11:30:12.125000Z",
                    "ingestion_ts": "2026-04-11T11:30:13.000000Z", "session_id": "visit-77",
                    "user_id": "shopper-4", "product_id": "K12", "sku": "tea-green", "page": "list",
                    "search_term": None, "device": "phone", "referrer": "letter"},
}


@pytest.mark.parametrize("topic", sorted(SAMPLE_BY_TOPIC))
def test_one_valid_event_per_topic(spark, topic):
    env = envelope(spark, topic, [json.dumps(SAMPLE_BY_TOPIC[topic])])
    row = silver.silver_frame(env, topic).first()
    assert row._dq_is_valid and list(row._dq_errors) == [] and row.event_ts is not None
    assert strict.check_events(env, topic).first()._strict_is_valid
    assert silver.valid_rows(silver.silver_frame(env, topic)).count() == 1


def test_plain_objects_are_sorted_as_the_parser_sorts_them(spark):
    from pyspark.sql import functions as F

    from lakecart.operators.strict import _sorted_members, sorted_json

    texts = ['{"b":1,"a":"x"}', '{"ab":1,"a":2,"a_b":3,"B":4}', '{"a":1.50,"b":1E5,"c":-0}', '{"a":12345678.5}', '{"a":1,"a":2}',
             '{"b":"x,","a":"{}:"}', '{"b":"q\\"z","a":[1,{"c":"}"}]}', '{ "b":1, "a":2 }', '{"é":"é","a":null}', '{}',
             '{"b":true,"a":-7.25,"c":"0.0"}', '{"a b":1,"a":0,"c":1.0E-7}']
    df = spark.createDataFrame([(t,) for t in texts], "p string").select("p", sorted_json(F.col("p")).alias("new"),
                                                                         _sorted_members(F.col("p")).alias("old"))
    rows = {r.p: r for r in df.collect()}
    assert all(r.new == r.old for r in rows.values())
    assert rows['{"ab":1,"a":2,"a_b":3,"B":4}'].new == '{"B":4,"a":2,"a_b":3,"ab":1}'
    # the parser stands behind the plain form, so that most rows do without it
    plan = df.select("new")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan and plan.index("regexp_extract_all") < plan.index("from_json")
