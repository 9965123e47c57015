import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eventide.session import build_session
    ckpt = tempfile.mkdtemp(prefix="eventide-test-ckpt-")
    s = build_session("local[*]", app_name="eventide-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="eventide-test-")
