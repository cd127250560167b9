import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from driftlog.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("driftlog-tests", master="local[4]", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    # Tests set their own checkpoint folder (none is configured locally).
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="driftlog-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="driftlog-test-")
