import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from marketlake.session import get_session
    ckpt = tempfile.mkdtemp(prefix="ml-test-ckpt-", dir="/tmp")
    s = get_session(master="local[4]", shuffle_partitions=4, extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="ml-test-", dir="/tmp")
