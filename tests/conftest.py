import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("TESSERA_MASTER", "local[4]")
    os.environ.setdefault("TESSERA_SHUFFLE_PARTITIONS", "8")
    from tessera.session import get_spark
    s = get_spark()
    yield s


@pytest.fixture(scope="session")
def con0001():
    from tessera.plans.check import duck
    return duck(SF0001)
