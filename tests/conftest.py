import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tradelens.session import get_spark

    s = get_spark("local[4]", 4, app_name="tradelens-tests")
    yield s


def rows(df, *cols):
    """Collect selected columns as plain tuples, sorted."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
