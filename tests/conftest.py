from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL_SF = os.environ.get("SLOTWISE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from slotwise.session import local_session
    session = local_session(cores="*", shuffle_partitions=8, app="slotwise-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SMALL_SF


@pytest.fixture()
def tmp_shared(spark, tmp_path):
    """A fresh folder (tests only; jobs use the shared checkpoint folder)."""
    return str(tmp_path)
