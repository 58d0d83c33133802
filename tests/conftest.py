from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from semestra.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        {
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false", "spark.sql.maxMetadataStringLength": "2000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(frame):
        return sorted((tuple(r) for r in frame.collect()), key=lambda r: tuple(str(v) for v in r))
    return collect
