from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from millrun.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8, app_name="millrun-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="millrun-test-")


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive asserts)."""
    cols = cols or tuple(df.columns)
    def key(t):
        return [(v is None, v if v is not None else 0) for v in t]

    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=key)
