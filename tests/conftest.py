import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskweave.session import build_session
    s = build_session("local[4]", app="riskweave-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="rw-test-ckpt-"),
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="rw-test-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
