import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from corvane.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "corvane-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return SF
