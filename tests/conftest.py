import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfspark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", app="tests", shuffle=4)
    yield session
    session.stop()


@pytest.fixture
def small_slices(spark):
    """Keep every shuffle slice, as large data would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
