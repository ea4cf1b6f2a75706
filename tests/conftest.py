import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from closebook.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="closebook-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as a list of tuples (test helper only)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
