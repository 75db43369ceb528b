import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from raincheck.session import build_session  # noqa: E402

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="raincheck-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_sf():
    if not os.path.isdir(SMALL_SF):
        pytest.skip("driver test data not present")
    return SMALL_SF
