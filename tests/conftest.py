import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeworks.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
                          spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="lakeworks-wh-", dir="/tmp"))
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="lakeworks-test-", dir="/tmp")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows as sorted tuples; columns default to all."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


@pytest.fixture
def tuples():
    return rows
