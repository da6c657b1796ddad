from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wardframe.session import get_session  # noqa: E402
from wardframe.shipping import ship_by_value  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ship_by_value()
    session = get_session(
        "tests",
        master="local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
