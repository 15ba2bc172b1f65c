import pytest

from lakecart.contracts import CONTRACTS, TOPICS, contract, select_topics


def test_registry_is_complete_and_valid():
    assert TOPICS == ("orders", "inventory", "pricing", "clickstream")
    for c in CONTRACTS.values():
        c.validate()
        assert c.event_time == "event_ts"
        assert c.primary_key == ("event_id",)
        assert c.required_names[:3] == ["event_id", "event_type", "event_ts"]


def test_contract_values():
    assert contract("orders").dedupe_key == ("order_id", "product_id", "event_ts")
    assert contract("inventory").lateness_minutes == 180
    assert contract("pricing").watermark_delay == "240 minutes"
    assert contract("clickstream").dedupe_key == ("session_id", "event_type", "event_ts")
    assert dict(contract("orders").required)["unit_price"] == "float"
    assert len(contract("orders").schema.fields) == 15


def test_topic_selection():
    assert select_topics(" orders, ,clickstream ") == ["orders", "clickstream"]
    assert select_topics(None) == list(TOPICS)
    with pytest.raises(ValueError):
        select_topics("orders,bogus")
