import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledger.session import local_session

    s = local_session("*", shuffle_partitions=8, app="ledger-tests",
                      checkpoint=tempfile.mkdtemp(prefix="ledger-test-ckpt-"))
    yield s
    s.stop()
