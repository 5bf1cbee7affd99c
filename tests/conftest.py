import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from clickflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("clickflow-tests", master="local[4]", shuffle_partitions=4)
    # tests only: no cluster folder is configured, so use a fresh scratch one
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clickflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="clickflow-test-")


def rows(df, cols=None):
    """Sorted list of tuples (order-insensitive comparison)."""
    cols = cols or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
