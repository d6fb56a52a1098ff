import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gristmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[8]", 8, "tests",
                            spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
                            spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
