import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import cases  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return cases.corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return cases.table(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return cases.table(spark, [])
