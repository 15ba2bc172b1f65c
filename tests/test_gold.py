"""Goldens from the invented orders and catalog (values worked out by hand)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import CATALOG_CSV, envelope, sample_order_payloads
from lakecart.operators import checks, gold, reports, silver
from lakecart.plans.registry import QUERIES
from lakecart.sources.catalog import duplicate_keys, load_catalog, read_catalog_csv, typed_catalog


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    p = tmp_path_factory.mktemp("cat") / "product_catalog.csv"
    p.write_text(CATALOG_CSV)
    return load_catalog(spark, str(p))


@pytest.fixture(scope="module")
def fact(spark, catalog):
    sil = silver.valid_rows(silver.silver_frame(envelope(spark, "orders", sample_order_payloads()), "orders"))
    return gold.orders_fact(gold.enrich_orders(sil, catalog))


def test_catalog_typed_and_unique(spark, catalog, tmp_path):
    assert catalog.count() == 8
    assert catalog.columns == ["product_id", "product_name", "category", "brand", "cost", "catalog_reorder_point"]
    row = catalog.filter("product_id = 'K11'").first()
    assert (row.cost, row.catalog_reorder_point) == (41.25, 12)
    dup = tmp_path / "dup.csv"
    dup.write_text(CATALOG_CSV + "K10,X,Dup,Cat,B,1,oops,x\n")
    with pytest.raises(ValueError):
        load_catalog(spark, str(dup))
    raw = read_catalog_csv(spark, str(dup))
    bad = typed_catalog(raw).filter("product_name = 'Dup'").first()
    assert bad.cost is None and bad.catalog_reorder_point is None     # try_cast, never an error
    assert [r[0] for r in duplicate_keys(typed_catalog(raw)).collect()] == ["K10"]


def test_enriched_margins(fact):
    got = {r.order_id: (r.product_name is not None, r.gross_margin) for r in fact.collect()}
    assert got == {
        "basket-101": (True, 48.25), "basket-102": (True, 10.25), "basket-103": (True, 145.7),
        "basket-104": (True, 159.98), "basket-105": (True, 53.95),
    }
    assert fact.columns == gold.ORDER_FACT_COLUMNS


def test_unknown_product_keeps_order_with_null_dimensions(spark, catalog):
    payloads = sample_order_payloads()
    payloads[0]["product_id"] = "P9999"
    sil = silver.valid_rows(silver.silver_frame(envelope(spark, "orders", payloads), "orders"))
    fact = gold.orders_fact(gold.enrich_orders(sil, catalog))
    r = fact.filter("product_id = 'P9999'").first()
    assert fact.count() == 5 and r.category is None and r.gross_margin is None
    daily = gold.revenue_daily(fact).filter(F.col("category").isNull()).first()
    assert daily.revenue == 89.5 and daily.gross_margin is None     # null group survives


def test_revenue_daily(fact):
    got = {(str(r.order_date), r.category, r.channel): (r.orders, r.units_sold, r.revenue, r.gross_margin)
           for r in gold.revenue_daily(fact).collect()}
    assert got == {
        ("2026-05-02", "Rugs", "app"): (1, 1, 345.6, 145.7),
        ("2026-05-02", "Lamps", "phone"): (1, 1, 95.2, 53.95),
        ("2026-05-02", "Lamps", "kiosk"): (1, 1, 89.5, 48.25),
        ("2026-05-02", "Chairs", "kiosk"): (1, 2, 415.98, 159.98),
        ("2026-05-02", "Kitchen", "kiosk"): (1, 1, 18.0, 10.25),
    }


def test_top_products_and_reports(fact):
    top = gold.top_products(fact)
    got = {r.product_id: (r.units_sold, r.revenue, r.orders) for r in top.collect()}
    assert got == {"K11": (2, 184.7, 2), "K13": (1, 18.0, 1), "K14": (2, 415.98, 1), "K15": (1, 345.6, 1)}
    ranked = [r.product_id for r in gold.rank_products(top).collect()]
    assert ranked == ["K14", "K15", "K11", "K13"]
    table = reports.top_products_table(top)
    assert table.columns == ["product_name", "category", "units_sold", "revenue"]
    assert table.first().revenue == 415.98
    by_channel = {r.channel: r.orders for r in reports.orders_by_channel(fact).collect()}
    assert by_channel == {"kiosk": 3, "app": 1, "phone": 1}
    trend = reports.revenue_trend(gold.revenue_daily(fact))
    assert {r.category: r.revenue for r in trend.collect()}["Lamps"] == 184.7


def test_top_products_of_orders_counts_before_the_join(spark):
    orders = spark.createDataFrame(
        [("o1", "p1", 2, 10.25), ("o1", "p1", 1, 5.0), ("o2", "p1", None, 1.005), (None, "p1", 1, 1.0), ("o3", "twice", 3, 7.5),
         ("o4", "twice", 1, None), ("o5", "renamed", 4, 2.0), ("o6", "unknown", 5, 3.0), ("o7", None, 6, 4.0), ("o8", None, 1, 1.0),
         ("o9", "void", None, None)],
        "order_id string, product_id string, quantity int, order_total double")
    catalog = spark.createDataFrame(
        [("p1", "n", "c", "b"), ("twice", "n", None, "b"), ("twice", "n", None, "b"), ("renamed", "x", "c", "b"),
         ("renamed", "y", "c", "b"), (None, "n", "c", "b"), ("void", "n", "c", "b"), ("unsold", "n", "c", "b")],
        "product_id string, product_name string, category string, brand string")
    want = gold.top_products(orders.join(catalog, "product_id", "left"))
    for most in (None, 100):  # left to the planner, broadcast
        got = gold.top_products_of(orders, catalog, most)
        assert got.dtypes == want.dtypes and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert ("twice", "n", None, "b", 8, 15.0, 2) in [tuple(r) for r in want.collect()]


@pytest.mark.parametrize("name", ["top_products", "top_products_table"])
def test_leaderboard_queries_shuffle_no_dimension_with_an_order(spark, tmp_path, name):
    day = datetime(2026, 5, 2)
    for table, row, schema in (
            ("lineitem", (1, 7, 3, 1, 2.0, 9.0), "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                                                 "l_quantity double, l_extendedprice double"),
            ("orders", (1, 5, "F", day, "web"), "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, "
                                                "o_orderpriority string"),
            ("part", (7, "n", "t", "b", 3, 4.0), "p_partkey long, p_name string, p_type string, p_brand string, p_size int, "
                                                 "p_retailprice double")):
        spark.createDataFrame([row], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    df = QUERIES[name](spark, str(tmp_path))
    assert (df.first().product_name, df.first().units_sold, df.first().revenue) == ("n", 2, 9.0)
    of_orders = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "sum(quantity" in x]
    assert of_orders and not any(c in x for x in of_orders for c in ("product_name", "category", "brand"))


def test_increment_distinct_counts_do_not_add_up(spark):
    # one order with two products, split over two micro-batches
    rows = [("O1", "P1", "2026-05-02 10:00:00", 1, 5.0, "c", "web"), ("O1", "P1", "2026-05-02 11:00:00", 1, 5.0, "c", "web")]
    df = spark.createDataFrame(rows, "order_id string, product_id string, event_ts string, quantity int, "
                                     "order_total double, category string, channel string") \
        .withColumn("event_ts", F.col("event_ts").cast("timestamp")) \
        .withColumn("product_name", F.lit("n")).withColumn("gross_margin", F.lit(1.0))
    b0 = gold.revenue_increment(df.limit(1), 0)
    b1 = gold.revenue_increment(df.subtract(df.limit(1)), 1)
    summed = sum(r.orders for r in b0.union(b1).collect())
    total = gold.revenue_daily(gold.orders_fact(df.withColumn("user_id", F.lit("u")).withColumn("brand", F.lit("b"))
                                                .withColumn("store_id", F.lit("s")).withColumn("unit_price", F.lit(5.0))
                                                .withColumn("status", F.lit("paid")))).first().orders
    assert (summed, total) == (2, 1)
    assert b0.first()._batch_id == 0


def test_data_tests(fact, spark):
    assert checks.failing_not_null(fact, "order_id").count() == 0
    neg = fact.withColumn("order_total", F.when(F.col("order_id") == "basket-103", -1.0)
                          .otherwise(F.col("order_total")))
    assert checks.failing_non_negative(neg, "order_total").count() == 1
    lv = spark.createDataFrame([("stockout",), ("weird",), (None,), ("weird",)], "inventory_risk_level string")
    got = {r.inventory_risk_level: r.n_rows for r in
           checks.failing_accepted_values(lv, "inventory_risk_level", ["stockout", "reorder", "healthy"]).collect()}
    assert got == {"weird": 2, None: 1}
    summary = checks.run_data_tests({"orders_gold": neg, "revenue_daily": gold.revenue_daily(neg),
                                     "top_products": gold.top_products(neg), "inventory_risk": lv})
    failures = {(r.model, r.column_name, r.test): r.failures for r in summary.collect()}
    assert failures[("orders_gold", "order_total", "non_negative")] == 1
    assert failures[("inventory_risk", "inventory_risk_level", "accepted_values")] == 3
    assert failures[("orders_gold", "order_id", "not_null")] == 0


def _silver_batch(spark, layout, batch, rows):
    from lakecart.sinks.writers import replace_partitions

    schema = ("order_id string, event_ts timestamp, user_id string, product_id string, product_name string, category string, "
              "brand string, store_id string, channel string, quantity int, unit_price double, order_total double, "
              "gross_margin double, status string, _dq_is_valid boolean, _batch_id bigint")
    full = [(o, ts, "u", "p", "n", "c", "b", "s", "web", 1, 2.0, 2.0, 1.0, "paid", ok, batch) for o, ts, ok in rows]
    replace_partitions(spark.createDataFrame(full, schema), layout.table("silver", "orders"), ["_batch_id"])


def test_refresh_reads_only_changed_days(spark, tmp_path):
    from datetime import datetime

    from lakecart.plans import gold_refresh
    from lakecart.sinks.layout import Layout

    layout = Layout.under(str(tmp_path))
    assert gold_refresh.refresh_changed(spark, layout) == {}
    day = lambda d: datetime(2026, 5, d, 10)
    _silver_batch(spark, layout, 0, [("a", day(1), True), ("b", day(2), True), ("c", day(3), True), ("bad", day(3), False)])
    tables = gold_refresh.refresh_changed(spark, layout)
    daily = lambda: {(r.order_date.day if r.order_date else None): r.orders for r in
                     spark.read.parquet(tables["revenue_daily_by_period"]).collect()}
    assert daily() == {1: 1, 2: 1, 3: 1}
    before = {f: (tmp_path / f).stat().st_mtime_ns for f in tmp_path.rglob("revenue_daily_by_period/order_period=2026-05-01/*.parquet")}
    assert before
    _silver_batch(spark, layout, 1, [("d", day(2), True), ("e", None, True)])
    _silver_batch(spark, layout, 2, [("f", day(9), True)])
    gold_refresh.refresh_changed(spark, layout)
    assert daily() == {1: 1, 2: 2, 3: 1, 9: 1, None: 1}
    assert {f: (tmp_path / f).stat().st_mtime_ns for f in before} == before  # untouched days are not written again
    read = gold_refresh.facts_of_periods(spark, layout, [day(2).date(), None])
    assert {f.split("order_period=")[1].split("/")[0] for f in read.inputFiles()} >= {"2026-05-02"}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(" in plan and "2026-05-02" in plan
    assert gold_refresh.refreshed_through(spark, layout) == 2
    gold_refresh.refresh_changed(spark, layout)  # nothing new
    assert gold_refresh.refresh_changed(spark, Layout.under(str(tmp_path / "none")), "month") == {}
    assert daily() == {1: 1, 2: 2, 3: 1, 9: 1, None: 1}


def test_tests_are_counted_while_tables_are_written(spark, tmp_path):
    from lakecart.operators.checks import DataTest, ObservedTests, StreamTests

    tests = (DataTest("m", "x", "not_null"), DataTest("m", "x", "non_negative"), DataTest("m", "s", "accepted_values", ("a",)),
             DataTest("other", "x", "not_null"))
    df = spark.createDataFrame([(1, "a"), (None, "b"), (-3, None), (-4, "a")], "x int, s string")
    seen = ObservedTests(tests)
    for n in range(2):
        seen.watch("m", df).write.parquet(str(tmp_path / f"m{n}"))
    seen.watch("untested", df).write.parquet(str(tmp_path / "u"))
    assert [(r.test, r.failures) for r in seen.results(spark).collect()] == [
        ("not_null", 2), ("non_negative", 4), ("accepted_values", 4)]
    empty = ObservedTests(tests)
    empty.watch("m", df.limit(0)).write.parquet(str(tmp_path / "e"))
    assert set(empty.failures().values()) == {0}

    listener = StreamTests(tests)
    spark.streams.addListener(listener)
    try:
        source = spark.readStream.schema("x int, s string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "m*"))
        query = (listener.watch("m", source).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
                 .trigger(availableNow=True).start(str(tmp_path / "out")))
        query.awaitTermination()
        import time

        files = len(list(tmp_path.glob("m*/*.parquet")))
        for _ in range(100):
            if len(listener._seen) >= files:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert list(listener.failures().values()) == [2, 4, 4]
