from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from tillwise.session import build_session

    session = build_session(
        "tillwise-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    from tillwise.sources.derived import DomainTables

    return DomainTables(spark, sf_dir)
