import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="tidemark-tests", shuffle_partitions=4)
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tidemark-test-")
