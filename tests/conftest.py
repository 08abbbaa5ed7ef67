import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from assaylake.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, memory="6g", app="tests")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def rows():
    """Rows of a frame as plain tuples, optionally sorted."""

    def take(df, sort=True):
        got = [tuple(r) for r in df.collect()]
        return sorted(got, key=repr) if sort else got

    return take
