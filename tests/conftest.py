import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from vintagelake.session import get_session
    s = get_session("vintagelake-tests", master="local[*]", shuffle_partitions=8)
    yield s
