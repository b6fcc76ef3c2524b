import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from aerocast.session import build_session

    ckpt = tempfile.mkdtemp(prefix="aerocast-test-ckpt-")
    s = build_session("local[4]", 4, app="aerocast-tests", checkpoint_dir=ckpt)
    yield s
    s.stop()
