import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratum.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # checkpoint folder is unset in tests, so set one (a fresh temp folder)
    session = local_session("stratum-tests", master="local[*]",
                            checkpoint_dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from stratum.session import scratch_path

    return lambda purpose="t": scratch_path(spark, purpose)
