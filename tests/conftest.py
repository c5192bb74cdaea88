import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clauseloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def values(df, *columns):
    """Rows as plain tuples, in the order they come."""
    return [tuple(r[c] for c in (columns or df.columns)) for r in df.collect()]
