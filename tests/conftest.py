from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens import build_session

    session = build_session("local[4]", 4, app_name="ledgerlens-tests", driver_memory="4g")
    yield session
    session.stop()


@pytest.fixture()
def scratch(tmp_path):
    """A fresh directory per test (pytest creates a new one each time)."""
    return str(tmp_path)


def rows(df, *cols):
    """Collected rows as plain tuples, sorted (order-insensitive compare)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
