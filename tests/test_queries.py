"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.compare import compare


NAMES = [name for module in entry.MODULES for name in module.QUERIES]


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, duck, name):
    assert compare(spark, duck, SMALL, name).startswith("same")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
