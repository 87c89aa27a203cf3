import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tabulon.session import get_spark, ship_package
    s = get_spark("tests", "*", shuffle_partitions=8)
    ship_package(s)
    yield s
    s.stop()
