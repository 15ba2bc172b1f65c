from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakecart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(app="lakecart-tests", master="local[4]", shuffle_partitions=4,
                      conf={"spark.driver.memory": "4g"})
    yield s
    s.stop()
