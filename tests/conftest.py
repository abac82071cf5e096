import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session
    s = build_session("local[4]", app="tidewater-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    # tests only: a checkpoint folder of our own, since none is configured
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tw-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="tw-test-")
