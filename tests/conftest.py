import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fundscope.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="fundscope-test-")


@pytest.fixture(scope="session")
def spark(scratch):
    s = local_session(cores="*", shuffle_partitions=8, scratch=scratch)
    yield s
