"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from lakecart.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)
    return [columns[i] for i in order], rows


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["order_date", "category", "channel", "orders", "units_sold", "revenue", "gross_margin"]
    assert df.count() == 4194


def test_every_query_has_an_oracle_or_is_rows_only():
    qs, orc = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(orc) <= set(qs)
    # the optional training-data queries are tested beside their own code
    assert set(QUERIES) <= set(qs) and set(QUERIES) <= set(orc)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(entry_mod.oracle_sql())))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry_mod.queries()[name](spark, SF)
    s_cols, s_rows = _rows(sdf.columns, [tuple(r) for r in sdf.collect()])
    cur = duck.execute(entry_mod.oracle_sql()[name])
    o_cols, o_rows = _rows([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows


def test_health_counts_batches_whose_log_entries_are_gone(spark, tmp_path):
    from lakecart.operators.health import layer_health
    from lakecart.sinks.layout import Layout

    lay = Layout.under(str(tmp_path))
    spark.range(3).write.parquet(lay.table("silver", "orders"))
    for sub in ("offsets", "commits"):
        folder = tmp_path / "checkpoints" / "silver" / "orders" / sub
        folder.mkdir(parents=True)
        for batch in (6, 7):                       # batches 0 to 5 were purged
            (folder / str(batch)).write_text("v1")
    rows = {r.kind: (r.commits, r.latest_commit, r.log_files) for r in layer_health(spark, lay, ("silver",)).collect()}
    assert rows == {"table": (8, "7", 2), "checkpoint": (8, "7", 2)}


def test_layer_contents(spark, tmp_path):
    from lakecart.operators.health import layer_contents
    from lakecart.sinks.layout import Layout

    lay = Layout.under(str(tmp_path))
    spark.sql("SELECT 1 AS x, TIMESTAMP'2026-05-02 10:00:00' AS event_ts").write.parquet(lay.table("silver", "orders"))
    rows = {(r.layer, r.table): (r.rows, str(r.max_event_ts)) for r in
            layer_contents(spark, lay, [("silver", "orders"), ("bronze", "orders")]).collect()}
    assert rows == {("silver", "orders"): (1, "2026-05-02 10:00:00")}


def test_health_counts_delta_log_commits(spark, tmp_path):
    from lakecart.operators.health import layer_health
    from lakecart.sinks.layout import Layout

    lay = Layout.under(str(tmp_path))
    spark.range(3).write.parquet(lay.table("gold", "t1"))
    log = tmp_path / "lakehouse" / "gold" / "t1" / "_delta_log"
    log.mkdir()
    for i in range(4):
        (log / f"{i:020d}.json").write_text("{}")
    spark.range(2).write.parquet(lay.table("gold", "plain"))
    rows = {r.table: (r.commits, r.latest_commit) for r in layer_health(spark, lay, ("gold",)).collect()}
    assert rows["t1"] == (4, f"{3:020d}.json")
    assert rows["plain"][0] == 1
