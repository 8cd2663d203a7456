import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", app_name="quayside-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="quayside-test-")


def rows(df, *cols):
    """Collected rows as tuples (sorted), optionally only ``cols``."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=_key)


def _key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)
