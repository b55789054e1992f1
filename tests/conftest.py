import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ferryline.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    from ferryline.runtime import shared_folder

    return shared_folder(spark, "test")


@pytest.fixture(scope="session")
def plan():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
