"""One local session for all tests."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallywick.session import local_session

    session = local_session(4, "tests", **{"spark__checkpoint__dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()
