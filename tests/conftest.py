import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gaugewell.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def plan():
    """Text of a plan; the final one when the query was run first."""

    def text(df, run=False) -> str:
        if run:
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
