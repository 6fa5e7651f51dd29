import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from signals.session import local_session, shared_dir

    s = local_session("*", shuffle_partitions=8, app="signals-tests")
    shared_dir(s)
    yield s


SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
