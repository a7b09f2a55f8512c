import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from dialtone.session import build_session
    s = build_session("local[*]", app_name="dialtone-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SMOKE_DIR = "/root/testdata/sf0.001"
