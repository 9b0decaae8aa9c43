import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from statloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("BENCH_CPUS", "8"), "statloom-tests")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a small table from rows and a schema string."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build
