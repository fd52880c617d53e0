from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from barloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            # Plans are compared as text: print them whole.
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.debug.maxToStringFields": "1000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new folder of its own for each test."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
