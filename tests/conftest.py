import os
import sys
import tempfile
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from mediacat.session import build

    session = build("local[4]", 4, "tests")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new folder for each test."""
    return tempfile.mkdtemp(prefix="mediacat-test-")


@pytest.fixture
def at():
    """Moments by number."""
    return lambda n: datetime(2024, 1, 1) + timedelta(hours=n)
