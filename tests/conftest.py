import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from carepulse.session import local_session
    s = local_session(4, app="carepulse-tests", shuffle_partitions=8)
    # tests own their shared folder; a cluster names one in spark.checkpoint.dir
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="carepulse-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from carepulse.session import new_scratch
    return lambda tag="t": new_scratch(spark, tag)
