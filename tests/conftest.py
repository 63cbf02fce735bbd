import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from newsfeat.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck_con():
    from oracle_compare import duck
    return duck(SF)
