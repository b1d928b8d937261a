import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import local_session

    session = local_session(os.environ.get("TEST_CORES", "8"))
    session.sparkContext.setLogLevel("ERROR")
    return session
