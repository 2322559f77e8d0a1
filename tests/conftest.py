import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tastemap.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="tastemap-tests",
                      extra={"spark.driver.memory": "6g",
                             "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8"})
    # Tests run without a cluster: the checkpoint folder is unset, so take our own.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tastemap-test-ckpt-"))
    yield s
    s.stop()
