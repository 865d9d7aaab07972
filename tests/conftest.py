import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("MILLRACE_DRIVER_MEMORY", "6g")
    session = build_session("local[8]", 4)
    yield session
    session.stop()
