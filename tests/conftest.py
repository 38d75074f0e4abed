import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from larkspur.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(8, memory="8g", app="larkspur-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
