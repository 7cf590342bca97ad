import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tastegrid.session import ensure_checkpoint_dir, local_session  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER
