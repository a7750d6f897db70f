import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from duologue import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", 8, spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")))
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
