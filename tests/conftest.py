import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from dimwright.session import local_session

    s = local_session("*", shuffle_partitions=8, app="dimwright-tests")
    yield s
    s.stop()
