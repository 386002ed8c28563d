import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from regstat.session import local_session

    s = local_session("*", shuffle_partitions=8, app="regstat-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="regstat-test-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="regstat-test-")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]
