from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for p in (ROOT, os.path.dirname(os.path.abspath(__file__))):
    if p not in sys.path:
        sys.path.insert(0, p)

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from quayside.session import build

    session = build("quayside-tests", cores="8", memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def rows(spark):
    """rows("a string, b int", (1, 2), ...) -> DataFrame"""
    return lambda ddl, *data: spark.createDataFrame(list(data), ddl)
