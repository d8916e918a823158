import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from voyra.session import build_session
    ckpt = tempfile.mkdtemp(prefix="voyra-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=8, app="voyra-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="voyra-test-")
