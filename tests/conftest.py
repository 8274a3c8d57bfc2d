import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stationflow.session import build_session
    s = build_session("local[4]", app_name="stationflow-tests",
                      conf={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture
def tmp_shared(spark):
    """A fresh folder under the session's checkpoint dir."""
    from stationflow.session import shared_path
    return shared_path(spark, "tests")
