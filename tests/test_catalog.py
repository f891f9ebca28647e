"""Every catalog query against its SQL at the smallest scale."""

from __future__ import annotations

import os

import pytest

from catalog.queries import CATALOG
from compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", CATALOG)
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(CATALOG) <= set(entry.queries())
