import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postwave.session import build_session, checkpoint_root  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir comes from the environment's Spark defaults when it names one;
    # checkpoint_root() gives a local session a temporary folder only when nothing is set.
    s = build_session(master="local[4]", shuffle_partitions=8)
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="postwave-test-")
