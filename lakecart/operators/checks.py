"""Column data tests (D9–D11): each returns the failing rows, and a one-pass summary runner."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def failing_non_negative(df: DataFrame, column: str) -> DataFrame:
    """Rows with a negative value; null passes."""
    return df.filter(F.col(column) < 0)


def failing_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Offending values with their row counts (null is not an accepted value)."""
    bad = ~F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    return df.filter(bad).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


@dataclass(frozen=True)
class DataTest:
    model: str
    column: str
    kind: str                     # not_null | non_negative | accepted_values
    values: tuple = ()

    def failing(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "non_negative":
            return F.coalesce(c < 0, F.lit(False))
        if self.kind == "accepted_values":
            return ~F.coalesce(c.isin(list(self.values)), F.lit(False))
        raise ValueError(f"unknown test kind {self.kind!r}")


# The gold model tests.
GOLD_TESTS = (
    DataTest("orders_gold", "order_id", "not_null"),
    DataTest("orders_gold", "order_total", "not_null"),
    DataTest("orders_gold", "order_total", "non_negative"),
    DataTest("revenue_daily", "order_date", "not_null"),
    DataTest("revenue_daily", "revenue", "non_negative"),
    DataTest("top_products", "product_id", "not_null"),
    DataTest("top_products", "revenue", "non_negative"),
    DataTest("inventory_risk", "inventory_risk_level", "accepted_values", ("stockout", "reorder", "healthy")),
)


def run_data_tests(models: dict[str, DataFrame], tests=GOLD_TESTS) -> DataFrame:
    """One row per test: model, column, test, failures.  One aggregation pass per model."""
    parts = []
    for model in dict.fromkeys(t.model for t in tests):
        mine = [t for t in tests if t.model == model]
        counts = models[model].agg(*[F.sum(t.failing().cast("bigint")).alias(f"_t{i}") for i, t in enumerate(mine)])
        stack = ", ".join(f"'{t.column}', '{t.kind}', coalesce(_t{i}, 0L)" for i, t in enumerate(mine))
        parts.append(counts.selectExpr(f"'{model}' AS model",
                                       f"stack({len(mine)}, {stack}) AS (column_name, test, failures)"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_RESULT = "model string, column_name string, test string, failures bigint"


def _metrics(tests: list[DataTest]) -> list[Column]:
    return [F.coalesce(F.sum(t.failing().cast("bigint")), F.lit(0)).cast("bigint").alias(f"t{i}") for i, t in enumerate(tests)]


class ObservedTests:
    """Data tests counted while a model is written, so that no second scan is needed.

    `watch(model, df)` returns `df` with the model's tests attached; the first action on it (the write) counts them.
    A model without tests is returned as it is; a model watched again (a later micro-batch) adds to its counts.
    """

    def __init__(self, tests=GOLD_TESTS):
        self.tests = {m: [t for t in tests if t.model == m] for m in dict.fromkeys(t.model for t in tests)}
        self._watched: list[tuple[str, Observation]] = []

    def watch(self, model: str, df: DataFrame) -> DataFrame:
        mine = self.tests.get(model)
        if not mine:
            return df
        seen = Observation()
        self._watched.append((model, seen))
        return df.observe(seen, *_metrics(mine))

    def failures(self) -> dict[DataTest, int]:
        """Failing rows per test of the watched models; waits for their writes."""
        out: dict[DataTest, int] = {}
        for model, seen in self._watched:
            for i, t in enumerate(self.tests[model]):
                out[t] = out.get(t, 0) + seen.get[f"t{i}"]
        return out

    def results(self, spark: SparkSession) -> DataFrame:
        """One row per test, as `run_data_tests`."""
        return spark.createDataFrame([(t.model, t.column, t.kind, n) for t, n in self.failures().items()], _RESULT)


class StreamTests(StreamingQueryListener):
    """The same for a stream: attach the tests with `watch`, add this listener to `spark.streams`, and every progress event
    adds its micro-batch's counts.  A repeated event of one micro-batch counts once."""

    def __init__(self, tests=GOLD_TESTS):
        self.tests = {m: [t for t in tests if t.model == m] for m in dict.fromkeys(t.model for t in tests)}
        self._seen: dict[tuple[str, str, int], list[int]] = {}

    def watch(self, model: str, df: DataFrame) -> DataFrame:
        mine = self.tests.get(model)
        return df.observe(f"tests:{model}", *_metrics(mine)) if mine else df

    def record(self, query_id: str, batch_id: int, metrics: dict) -> None:
        for model, mine in self.tests.items():
            row = metrics.get(f"tests:{model}")
            if row is not None:
                self._seen[(model, str(query_id), int(batch_id))] = [row[f"t{i}"] or 0 for i in range(len(mine))]

    def failures(self) -> dict[DataTest, int]:
        out: dict[DataTest, int] = {}
        for (model, _, _), counts in list(self._seen.items()):
            for t, n in zip(self.tests[model], counts, strict=True):
                out[t] = out.get(t, 0) + n
        return out

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.record(p.id, p.batchId, p.observedMetrics)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
