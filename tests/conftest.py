import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kpilens.session import get_spark
    s = get_spark("kpilens-tests", "*", shuffle_partitions=8)
    yield s
    s.stop()
