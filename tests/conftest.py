"""One local session for all tests; small tables from plain rows."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fieldlens.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("local[4]", 4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "3g"})
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def frame(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)
