"""SURVEY §2 operator ids → the callables that implement them and the queries that run them.

Checked by tests/test_coverage.py: every id is listed, every callable imports and every
id has a registered query with a DuckDB oracle.
"""

from __future__ import annotations

COVERAGE: dict[str, tuple[list[str], list[str]]] = {
    # scans / sources
    "S1": (["lakecart.sources.bus.bus_stream", "lakecart.sources.bus.file_bus_stream"], ["stream_bronze"]),
    "S2": (["lakecart.sources.bus.envelope", "lakecart.sources.bus.bronze"], ["bronze_envelope"]),
    "S3": (["lakecart.sources.catalog.read_catalog_csv", "lakecart.sources.catalog.typed_catalog"], ["catalog_csv_scan", "catalog_scan"]),
    "S4": (["lakecart.sources.tables.read_table_if_exists"], ["refresh_revenue_daily"]),
    "S5": (["lakecart.sources.tables.register_sources"], ["sql_revenue_daily", "sql_inventory_risk"]),
    "S6": (["lakecart.sources.catalog.load_catalog"], ["catalog_seed"]),
    "S7": (["lakecart.sources.jsonl.read_jsonl_events", "lakecart.sources.jsonl.jsonl_envelope"], ["jsonl_orders"]),
    # sinks
    "K1": (["lakecart.sinks.writers.write_stream"], ["stream_bronze", "stream_quarantine"]),
    "K2": (["lakecart.streaming.topic_streams.OrderGoldBatchWriter"], ["stream_gold_increment"]),
    "K3": (["lakecart.sinks.writers.write_overwrite", "lakecart.plans.gold_refresh.refresh",
            "lakecart.plans.gold_refresh.refresh_changed", "lakecart.sinks.evolving.append_evolving"],
           ["refresh_revenue_daily", "refresh_inventory_risk", "refresh_changed_days", "evolving_orders"]),
    "K4": (["lakecart.sinks.layout.Layout"], ["layer_health"]),
    "K5": (["lakecart.sinks.writers.publish_frame", "lakecart.sinks.writers.publish_to_bus",
            "lakecart.sinks.writers.publish_to_files"], ["publish_gate"]),
    "K6": (["lakecart.sinks.writers.materialize", "lakecart.plans.sql_models.build_models"], ["sql_model_tests"]),
    # projections
    "P1": (["lakecart.operators.silver.parse_topic", "lakecart.functions.jsonfmt.parse_payload"], ["parse_clickstream"]),
    "P2": (["lakecart.operators.silver.parse_topic"], ["parse_clickstream"]),
    "P3": (["lakecart.functions.time.parse_event_time"], ["parse_clickstream"]),
    "P4": (["lakecart.functions.money.gross_margin"], ["enrich_orders"]),
    "P5": (["lakecart.operators.gold.orders_fact"], ["orders_gold"]),
    "P6": (["lakecart.operators.gold.orders_fact"], ["orders_gold"]),
    "P7": (["lakecart.sources.bus.bronze", "lakecart.operators.gold.revenue_increment"],
           ["bronze_envelope", "revenue_increment"]),
    "P8": (["lakecart.operators.gold.stage_orders"], ["stg_orders"]),
    "P9": (["lakecart.operators.gold.stage_inventory"], ["stg_inventory"]),
    "P10": (["lakecart.operators.inventory.risk_level", "lakecart.plans.sql_models.build_models"],
            ["inventory_risk", "sql_inventory_risk"]),
    "P11": (["lakecart.operators.inventory.with_risk"], ["inventory_latest"]),
    # filters
    "F1": (["lakecart.operators.silver.valid_rows"], ["silver_clickstream", "silver_pricing", "silver_inventory"]),
    "F2": (["lakecart.operators.silver.quarantine_rows"], ["quarantine_clickstream", "stream_quarantine"]),
    "F3": (["lakecart.operators.gold.stage_orders"], ["stg_orders"]),
    "F4": (["lakecart.operators.inventory.latest_state"], ["inventory_latest"]),
    "F5": (["lakecart.operators.inventory.inventory_alerts"], ["inventory_alerts"]),
    "F6": (["lakecart.contracts.select_topics"], ["stream_topic_subset"]),
    # joins
    "J1": (["lakecart.operators.gold.enrich_orders", "lakecart.operators.joins.join_dimension"], ["enrich_orders"]),
    # aggregations
    "A1": (["lakecart.operators.gold.revenue_daily"], ["revenue_daily", "sql_revenue_daily"]),
    "A2": (["lakecart.operators.gold.top_products", "lakecart.operators.gold.top_products_of"], ["top_products"]),
    "A3": (["lakecart.operators.gold.revenue_increment", "lakecart.operators.additive.AdditiveRevenueWriter",
            "lakecart.operators.additive.additive_totals"],
           ["revenue_increment", "stream_gold_increment", "additive_revenue_daily", "stream_additive_revenue"]),
    "A4": (["lakecart.operators.reports.orders_by_channel"], ["orders_by_channel"]),
    "A5": (["lakecart.operators.reports.revenue_trend"], ["revenue_trend"]),
    # windows
    "W1": (["lakecart.operators.inventory.latest_state", "lakecart.streaming.topic_streams.latest_inventory_stream",
            "lakecart.streaming.topic_streams.read_latest_inventory"], ["inventory_latest", "stream_inventory_latest"]),
    "W2": (["lakecart.operators.inventory.stock_ledger", "lakecart.operators.ledger_store.LedgerStore"],
           ["stock_ledger", "stock_ledger_continued"]),
    # sorts
    "O1": (["lakecart.operators.gold.order_revenue_daily"], ["revenue_daily_ordered"]),
    "O2": (["lakecart.operators.gold.rank_products"], ["top_products_table"]),
    # scalars
    "X1": (["lakecart.functions.jsonfmt.parse_payload"], ["parse_clickstream"]),
    "X2": (["lakecart.functions.jsonfmt.canonical_json"], ["silver_pricing"]),
    "X3": (["lakecart.functions.time.parse_event_time"], ["parse_clickstream"]),
    "X4": (["lakecart.operators.gold.orders_fact"], ["orders_gold"]),
    "X5": (["lakecart.functions.time.iso_utc_text"], ["event_fingerprint"]),
    "X6": (["lakecart.functions.time.as_timestamp_literal"], ["late_flag"]),
    "X7": (["lakecart.functions.time.minutes_before"], ["late_flag"]),
    "X8": (["lakecart.sources.bus.envelope", "lakecart.sources.catalog.typed_catalog"], ["catalog_scan"]),
    "X9": (["lakecart.functions.money.round_money"], ["revenue_daily"]),
    "X10": (["lakecart.operators.inventory.risk_level"], ["inventory_risk"]),
    "X11": (["lakecart.functions.quality.required_null_errors"], ["dq_errors"]),
    "X12": (["lakecart.functions.quality.error_list"], ["dq_errors"]),
    "X13": (["lakecart.sources.bus.bronze"], ["bronze_envelope"]),
    "X14": (["lakecart.functions.fingerprint.fingerprint"], ["event_fingerprint"]),
    # streaming
    "T1": (["lakecart.operators.silver.stream_dedupe"], ["stream_silver_clickstream", "stream_dedupe_orders"]),
    "T2": (["lakecart.operators.silver.stream_dedupe", "lakecart.operators.silver.collapse_copies",
            "lakecart.operators.silver.dedupe_events"],
           ["stream_dedupe_orders", "stream_collapsed_clickstream", "dedupe_orders"]),
    "T3": (["lakecart.operators.silver.add_late_flag"], ["late_flag"]),
    "T4": (["lakecart.streaming.topic_streams.watermark_drops", "lakecart.streaming.topic_streams.DropListener",
            "lakecart.streaming.topic_streams.KeepLateBatchWriter"], ["stream_watermark_drops", "stream_late_rows"]),
    "T5": (["lakecart.sinks.writers.write_stream"], ["stream_bronze"]),
    "T6": (["lakecart.streaming.topic_streams.start_topic", "lakecart.streaming.topic_streams.start_topic_shared",
            "lakecart.streaming.topic_streams.start_all"], ["stream_silver_inventory", "stream_silver_pricing", "stream_shared_dedupe_orders",
            "layer_contents"]),
    "T7": (["lakecart.streaming.topic_streams.await_queries"], ["stream_bronze"]),
    "T8": (["lakecart.sinks.layout.Layout", "lakecart.operators.health.state_contents"], ["layer_health", "stream_state_rows"]),
    "T9": (["lakecart.streaming.topic_streams.OrderGoldBatchWriter"], ["stream_gold_increment"]),
    # data quality
    "D1": (["lakecart.operators.silver.add_quality"], ["dq_errors"]),
    "D2": (["lakecart.operators.silver.add_quality"], ["dq_errors"]),
    "D3": (["lakecart.operators.strict.check_events"], ["strict_type_errors"]),
    "D4": (["lakecart.operators.strict.timestamp_errors"], ["timestamp_errors"]),
    "D5": (["lakecart.functions.time.parse_iso_time"], ["timestamp_errors"]),
    "D6": (["lakecart.operators.strict.late_by_payload"], ["is_late"]),
    "D7": (["lakecart.functions.fingerprint.fingerprint"], ["event_fingerprint"]),
    "D8": (["lakecart.operators.strict.publish_gate"], ["publish_gate"]),
    "D9": (["lakecart.operators.checks.failing_not_null", "lakecart.operators.checks.ObservedTests",
            "lakecart.operators.checks.StreamTests"], ["check_not_null", "data_tests", "data_tests_observed"]),
    "D10": (["lakecart.operators.checks.failing_non_negative"], ["check_non_negative", "data_tests"]),
    "D11": (["lakecart.operators.checks.failing_accepted_values"], ["check_accepted_values", "data_tests"]),
    "D12": (["lakecart.operators.health.layer_health", "lakecart.operators.health.layer_contents"],
            ["layer_health", "layer_contents"]),
    # report queries
    "R1": (["lakecart.operators.reports.revenue_trend"], ["revenue_trend"]),
    "R2": (["lakecart.operators.reports.orders_by_channel"], ["orders_by_channel"]),
    "R3": (["lakecart.operators.reports.top_products_table"], ["top_products_table"]),
    "R4": (["lakecart.operators.reports.low_inventory_table"], ["low_inventory_table"]),
}
