import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cadenza.session import get_spark

    # The checkpoint folder comes from the session's settings; get_spark sets a temporary
    # one only when none is configured (local master only).
    s = get_spark("local[4]", shuffle_partitions=8, app="cadenza-tests", driver_memory="8g")
    yield s
    s.stop()
