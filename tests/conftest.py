import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from moodlake.session import build_session, checkpoint_dir
    s = build_session(master="local[*]", shuffle_partitions=8, app="moodlake-tests")
    checkpoint_dir(s)
    yield s
    s.stop()

