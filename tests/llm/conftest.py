import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_rows import ROWS, documents  # noqa: E402


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing columns."""
    return documents(spark, ROWS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])
