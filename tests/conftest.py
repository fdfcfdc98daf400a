import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cartlens.session import local_session

    session = local_session("tests", cores="8", shuffle=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    got = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return got if order else sorted(got, key=str)


def values(df):
    """The first column in frame order."""
    return [r[0] for r in df.collect()]
