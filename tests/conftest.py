import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagedater.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
GATE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
