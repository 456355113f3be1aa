import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tablewright.session import get_spark, shared_dir
    s = get_spark("local[4]", shuffle_partitions=4)
    shared_dir(s)
    yield s
    s.stop()


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
