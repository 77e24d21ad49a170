import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.session import get_spark  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark(app_name="tillroll-tests", master="local[*]", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        # Tests only: the cluster would name a shared folder in spark.checkpoint.dir.
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillroll-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tillroll-test-")
