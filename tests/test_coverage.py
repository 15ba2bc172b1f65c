"""Every SURVEY §2 id is implemented by importable callables and run by registered queries."""

import importlib

from lakecart.plans.coverage import COVERAGE
from lakecart.plans.registry import QUERIES
from oracles import ORACLES

GROUPS = {"S": 7, "K": 6, "P": 11, "F": 6, "J": 1, "A": 5, "W": 2, "O": 2, "X": 14, "T": 9, "D": 12, "R": 4}


def test_every_inventory_id_is_listed():
    want = {f"{g}{i}" for g, n in GROUPS.items() for i in range(1, n + 1)}
    assert set(COVERAGE) == want


def test_callables_import_and_queries_exist():
    for op_id, (callables, queries) in COVERAGE.items():
        assert callables, op_id
        for path in callables:
            module, attr = path.rsplit(".", 1)
            assert callable(getattr(importlib.import_module(module), attr)), path
        assert queries, op_id
        for q in queries:
            assert q in QUERIES and q in ORACLES, (op_id, q)


def test_every_registered_query_covers_some_id():
    used = {q for _, qs in COVERAGE.values() for q in qs}
    assert set(QUERIES) <= used
