"""Physical-plan properties the scale design relies on (checked on the sf0.001 driver tables)."""

import os

import pytest

from lakecart.operators import gold, inventory, silver
from lakecart.sources import bus, testviews

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fx(spark):
    return testviews.load_fixtures(spark, SF)


def test_scan_is_pruned_and_filter_pushed(fx):
    p = plan(gold.revenue_daily(gold.orders_fact(gold.enrich_orders(fx["orders"], fx["catalog"]))))
    import re
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    lineitem = [r for r in schemas if "l_orderkey" in r][0]
    only = plan(gold.enrich_orders(fx["orders"], fx["catalog"].filter("catalog_reorder_point > 5")))
    assert "GreaterThan(p_size,5)" in only                             # a catalog filter reaches the scan
    assert lineitem == "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>"


def test_small_dimension_is_broadcast_large_is_not(fx):
    enriched = gold.enrich_orders(fx["orders"], fx["catalog"])
    p0 = plan(enriched)
    assert "BroadcastHashJoin" in p0 and "LeftOuter, BuildRight" in p0
    capped = gold.enrich_orders(fx["orders"], fx["catalog"], broadcast_max_rows=10)
    hinted = capped._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in hinted                           # no forced broadcast beyond the bound
    assert "strategy=broadcast" in enriched._jdf.queryExecution().analyzed().toString()
    assert capped.count() == enriched.count()
    bytes_capped = gold.enrich_orders(fx["orders"], fx["catalog"])  # row bound fine …
    from lakecart.operators.joins import fits_broadcast
    assert fits_broadcast(fx["catalog"]) and not fits_broadcast(fx["catalog"], max_bytes=1000)  # … byte bound not
    assert bytes_capped.count() == enriched.count()


def test_distinct_aggregation_has_no_expand_and_combines_map_side(fx):
    daily = gold.revenue_daily(gold.orders_fact(gold.enrich_orders(fx["orders"], fx["catalog"])))
    p = daily._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in p
    assert p.count("HashAggregate") >= 4 and "partial_sum" in p


def test_latest_state_limits_before_the_shuffle(fx, spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")             # show the static plan
    try:
        p = inventory.latest_state(fx["inventory"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("WindowGroupLimit") == 2                             # partial (map side) + final
    before_exchange = p.split("Exchange")[1]
    assert "WindowGroupLimit" in before_exchange


def test_quality_flag_not_reinlined_into_a_filter(fx):
    env = bus.envelope(fx["click_records"])
    valid = silver.valid_rows(silver.silver_frame(env, "clickstream"))
    opt = valid._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in opt
    filters = [line for line in opt.splitlines() if line.strip().startswith(("Filter", "+- Filter", ":- Filter"))]
    assert not any("from_json" in f for f in filters)


def test_ledger_rows_not_shuffled_by_key_alone(fx, spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        led = inventory.stock_ledger(fx["inventory"], initial="reorder_point")
        p = led._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
    # the row-level shuffle is keyed by key and bucket; only the small per-bucket table is keyed by key
    assert any("_seg" in e for e in exchanges)
    assert "_tb" not in p.split("Exchange SinglePartition")[0] or "SinglePartition" not in p


def test_salted_join_beyond_the_bound_keeps_results(fx):
    plain = gold.enrich_orders(fx["orders"], fx["catalog"])
    salted = gold.enrich_orders(fx["orders"], fx["catalog"], broadcast_max_rows=10, salt_buckets=4)
    assert "_salt" in plan(salted)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_salted_copies_are_not_broadcast(fx):
    salted = gold.enrich_orders(fx["orders"], fx["catalog"], broadcast_max_rows=10, salt_buckets=4)
    p = salted._jdf.queryExecution().sparkPlan().toString()
    # the catalog's files are far below Spark's own bound for broadcasts, its copies need not be
    assert any("SortMergeJoin" in line and "_salt" in line for line in p.splitlines())
    assert not any("BroadcastHashJoin" in line and "_salt" in line for line in p.splitlines())


def test_json_lines_are_written_compressed_and_bounded(spark, tmp_path, monkeypatch):
    from lakecart import session
    from lakecart.plans import registry

    spark.range(50).selectExpr("id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "timestamp'1997-02-03' AS o_orderdate",
                               "'1-URGENT' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(200).selectExpr("id % 50 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "cast(id AS int) AS l_linenumber",
                                "2.0d AS l_quantity", "9.0d AS l_extendedprice").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(registry, "JSONL_FILE_ROWS", 40)
    monkeypatch.setattr(session, "run_dir", lambda _spark, name: str(tmp_path / name))
    out = registry.jsonl_orders(spark, str(tmp_path))
    files = list((tmp_path / "jsonl" / "orders").glob("part-*"))
    assert {f.suffix for f in files} == {".gz"} and len(files) >= 5
    assert out.count() == 200 and out.where("order_total = 9.0 AND order_id IS NOT NULL").count() == 200


def test_silver_tables_of_the_models_are_written_compressed(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    from lakecart import session
    from lakecart.plans import registry

    rows = "id AS l_orderkey, id AS l_partkey, id AS l_suppkey, 1 AS l_linenumber, 2.0d AS l_quantity, timestamp'1997-02-03' AS l_shipdate"
    spark.range(50).selectExpr(*rows.split(", ")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(50).selectExpr("id AS p_partkey", "3 AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(session, "run_dir", lambda _spark, name: str(tmp_path / name))
    layout = registry._silver_tables(spark, str(tmp_path), ["inventory"])
    files = list((tmp_path / "stream-silver").rglob("*.parquet"))
    files = [f for f in files if f.is_file()]
    assert spark.read.parquet(layout.table("silver", "inventory")).count() == 50
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
