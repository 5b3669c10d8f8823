import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from staylake.session import build_session
    wh = tmp_path_factory.mktemp("warehouse")
    s = build_session("local[4]", app="staylake-tests", shuffle_partitions=8,
                      **{"spark__sql__warehouse__dir": str(wh)})
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
