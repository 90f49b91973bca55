import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    from rentrisk.session import build_session
    s = build_session("local[8]", shuffle_partitions=8)
    yield s
    s.stop()
