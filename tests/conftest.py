import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rowtide.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="rowtide-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rowtide-test-ckpt-"))
    yield s
    s.stop()
