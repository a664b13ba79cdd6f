import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlark.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, driver_memory="4g")
    yield s
    s.stop()
