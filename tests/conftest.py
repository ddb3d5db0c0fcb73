import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from thumbwheel.session import local_session, work_root  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="4g", app="tests")
    session.sparkContext.setLogLevel("ERROR")
    work_root(session)
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="thumbwheel-test-")


@pytest.fixture(scope="session")
def sf_dir():
    return SF
