import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tierwise.session import build_session
    warehouse = tempfile.mkdtemp(prefix="tierwise-test-warehouse-")
    s = build_session("local[4]", app_name="tierwise-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": warehouse})
    # Tests run in local mode with no shared folder configured: use a
    # fresh temporary one (on a cluster spark.checkpoint.dir is required).
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tierwise-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(spark):
    from tierwise.session import scratch_path
    return scratch_path(spark, "test")
