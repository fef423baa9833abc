import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

# Oracle tests run on the smallest tables by default; set CORVID_TEST_SF to
# another folder (e.g. /root/testdata/sf0.01) for the driver's scale.
SF_DIR = os.environ.get("CORVID_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from corvid.session import build_session

    session = build_session(master="local[8]", shuffle_partitions=8,
                            checkpoint_dir=tempfile.mkdtemp(prefix="corvid-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def workdir():
    """A fresh local folder for fixture files written by a test."""
    return tempfile.mkdtemp(prefix="corvid-test-")
