import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from opinio.session import local_session
    s = local_session(cores="*", shuffle_partitions=8,
                      checkpoint_dir=tempfile.mkdtemp(prefix="opinio-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from harness import duck
    return duck(SMALL)


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="opinio-test-", dir="/tmp")
