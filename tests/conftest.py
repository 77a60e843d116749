import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starling.session import build_session
    s = build_session("local[4]", app="starling-tests", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as a sorted list of tuples (order-insensitive comparisons)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
