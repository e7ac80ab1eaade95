import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from hubcast.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect ``cols`` as sorted tuples (None sorts first)."""
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))
