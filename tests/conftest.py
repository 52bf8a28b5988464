import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", 4)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=str)

    return collect
