import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stratiform.session import build_session
    s = build_session("local[4]", app="stratiform-tests", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
