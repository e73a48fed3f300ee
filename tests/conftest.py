import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import build_session

    s = build_session("local[4]", app_name="tillroll-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    # a fresh folder per test; never cleared, never reused
    return tempfile.mkdtemp(prefix="tillroll-test-")
