import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd import no_docs, odd_docs  # noqa: E402


@pytest.fixture
def docs(spark):
    return odd_docs(spark)


@pytest.fixture
def nothing(spark):
    return no_docs(spark)
