import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.session import cleanup_staging, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, app="quire-tests")
    yield s
    cleanup_staging(s)


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
