import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from wareflow.session import build_session, checkpoint_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="wareflow-tests")
    checkpoint_root(s)  # set one only when the session has none
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from wareflow.session import scratch_path
    return lambda name="t": scratch_path(spark, name)


def rows(df, *cols):
    """Sorted list of tuples of the given (or all) columns."""
    cols = cols or tuple(df.columns)
    key = lambda t: tuple((1, 0) if v is None else (0, v) for v in t)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=key)
