import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("NIGHTSHIFT_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from nightshift.session import local_session

    s = local_session(cores="*", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
