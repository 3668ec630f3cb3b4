import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from matchmart.session import local_session  # noqa: E402
from matchmart.workspace import Workspace  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, memory="6g", **{"spark.sql.maxMetadataStringLength": "100000"})


@pytest.fixture
def space(spark):
    return Workspace(spark)


@pytest.fixture(scope="session")
def small():
    return f"{TESTDATA}/sf0.001"
