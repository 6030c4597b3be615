import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import local_session

    session = local_session("*", shuffle_partitions=8, app="ledgerline-tests")
    yield session
    session.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
