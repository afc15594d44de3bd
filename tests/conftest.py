import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from bitlake.session import get_session
    s = get_session("local[4]", app="bitlake-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    # Tests run without a cluster: give the session its own checkpoint folder.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bitlake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def workdir():
    return tempfile.mkdtemp(prefix="bitlake-test-")
