import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reelcast.session import get_session
    s = get_session("local[4]", 8)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reelcast-test-ckpt-"))
    yield s


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="reelcast-test-")
