import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from weblattice.session import local_session
    s = local_session(4, 4, app="weblattice-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wl-test-ckpt-"))
    yield s


@pytest.fixture
def tmp_out():
    return tempfile.mkdtemp(prefix="wl-test-out-")


def ranks_of(df, col="rank"):
    return {r["node"]: round(r[col], 6) for r in df.collect()}
