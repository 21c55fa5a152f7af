import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import pytest

from tools.compare import duck_connection, session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(scope="session")
def duck():
    return duck_connection(SMALL)


@pytest.fixture
def frame(spark):
    """Literal rows: frame("a long, b double", (1, 2.0), ...)."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make
