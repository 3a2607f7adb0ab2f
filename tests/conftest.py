from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from kinetable.plans.skew import HOT_ROWS_CONF  # noqa: E402
from kinetable.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4)
    yield session
    session.stop()


@pytest.fixture
def tiny_limit(spark):
    """Every key above 20 rows counts as hot, so small data takes the plan for huge keys."""
    spark.conf.set(HOT_ROWS_CONF, "20")
    yield
    spark.conf.unset(HOT_ROWS_CONF)


@pytest.fixture(scope="session")
def duck():
    if not Path(SMALL).is_dir():
        pytest.skip("no test tables here")
    from oracle import connect

    return connect(SMALL)
