import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from rankmill import get_spark

    s = get_spark("local[4]", app_name="rankmill-tests", shuffle_partitions=4)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
