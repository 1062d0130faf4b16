import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gistlet.session import get_spark, work_dir
    s = get_spark("local[*]", app="gistlet-tests", shuffle_partitions=8)
    work_dir(s)  # registers a private checkpoint folder for tests (unset otherwise)
    yield s
    s.stop()
