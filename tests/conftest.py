import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tarmac.session import local_session

    session = local_session("*", "tarmac-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def full(spark):
    from checks import frames
    from tarmac.session import materialise

    return materialise(frames.clean(spark, SF))


@pytest.fixture(scope="session")
def op(full):
    from tarmac.operators import cleaning

    return cleaning.operated(full)
