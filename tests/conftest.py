import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from recspark.session import get_session
    s = get_session("local[4]", app="recspark-tests", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally a column subset)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
