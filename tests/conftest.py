import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for place in (str(ROOT), str(ROOT / "tests")):
    if place not in sys.path:
        sys.path.insert(0, place)

from lagline.session import SERIES_ROWS, local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny_tasks(spark):
    """Treat every series of more than 20 rows as long."""
    spark.conf.set(SERIES_ROWS, "20")
    yield
    spark.conf.unset(SERIES_ROWS)
