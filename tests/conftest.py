import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", "tests")


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a list of tuples sorted by their text."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
