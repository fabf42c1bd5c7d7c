import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tw-test-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from tidewater.session import scratch_path
    return scratch_path(spark, "test")
