"""SQL models: staged views over silver, gold tables, and their column tests.

For users who keep their models as SQL.  The statements share the DataFrame
operators' column lists; metrics, risk level and ranking are written here a second
time, as SQL text, and both forms are held to the same oracle.  Sources are the temp views `orders_silver`,
`inventory_silver` (and optionally `product_catalog`); models are created in
dependency order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakecart.operators.checks import GOLD_TESTS, run_data_tests
from lakecart.operators.gold import (LEADERBOARD_KEY, ORDER_FACT_COLUMNS, REVENUE_DAILY_KEY, STAGED_INVENTORY_COLUMNS,
                                     STAGED_ORDER_COLUMNS)
from lakecart.operators.inventory import HEALTHY, INVENTORY_KEY, REORDER, RISK_MODEL_COLUMNS, STOCKOUT
from lakecart.sinks.writers import materialize

_DERIVED = {
    "event_ts": "CAST(event_ts AS TIMESTAMP)",
    "order_date": "CAST(event_ts AS DATE)",
    "inventory_risk_level": (f"CASE WHEN available_to_promise <= 0 THEN '{STOCKOUT}' "
                             f"WHEN available_to_promise <= reorder_point THEN '{REORDER}' ELSE '{HEALTHY}' END"),
}
_METRICS = {
    "orders": "count(DISTINCT order_id)",
    "units_sold": "sum(quantity)",
    "revenue": "round(sum(order_total), 2)",
    "gross_margin": "round(sum(gross_margin), 2)",
}


def _project(columns: list[str], derived: tuple[str, ...] = ()) -> str:
    return ", ".join(f"{_DERIVED[c]} AS {c}" if c in derived else c for c in columns)


def _valid(source: str) -> str:
    return f"(SELECT * FROM {source} WHERE _dq_is_valid = true)"


def _rollup(source: str, keys: list[str], metrics: list[str]) -> str:
    cols = ", ".join([*keys, *[f"{_METRICS[m]} AS {m}" for m in metrics]])
    return f"SELECT {cols} FROM {source} GROUP BY {', '.join(keys)}"


def _latest(source: str) -> str:
    part = ", ".join(INVENTORY_KEY)
    return (f"(SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY event_ts DESC, event_id DESC) AS _rank "
            f"FROM {_valid(source)}) WHERE _rank = 1")


# (name, materialisation, statement); the risk model ranks silver rows so event_id can break time ties
MODELS: list[tuple[str, str, str]] = [
    ("stg_orders", "view",
     f"SELECT {_project(STAGED_ORDER_COLUMNS, ('event_ts', 'order_date'))} FROM {_valid('orders_silver')}"),
    ("stg_inventory", "view",
     f"SELECT {_project(STAGED_INVENTORY_COLUMNS, ('event_ts',))} FROM {_valid('inventory_silver')}"),
    ("orders_gold", "table", f"SELECT {_project(ORDER_FACT_COLUMNS)} FROM stg_orders"),
    ("revenue_daily", "table",
     _rollup("stg_orders", REVENUE_DAILY_KEY, ["orders", "units_sold", "revenue", "gross_margin"])),
    ("top_products", "table", _rollup("stg_orders", LEADERBOARD_KEY, ["units_sold", "revenue", "orders"])),
    ("inventory_risk", "table",
     f"SELECT {_project(RISK_MODEL_COLUMNS, ('event_ts', 'inventory_risk_level'))} FROM {_latest('inventory_silver')}"),
]


def build_models(spark: SparkSession, table_path=None, fmt: str = "parquet",
                 only: list[str] | None = None) -> dict[str, DataFrame]:
    """Create every model.  Tables are written to `table_path(name)` when given, else kept as views."""
    out = {}
    for name, kind, sql in MODELS:
        if only and name not in only:
            continue
        df = spark.sql(sql)
        if kind == "table" and table_path is not None:
            materialize(spark, df, name, "table", table_path(name), fmt)
        else:
            materialize(spark, df, name, "view")
        out[name] = spark.table(name)
    return out


def test_models(spark: SparkSession) -> DataFrame:
    """The model column tests: one row per test with its failure count."""
    return run_data_tests({m: spark.table(m) for m in {t.model for t in GOLD_TESTS}})
