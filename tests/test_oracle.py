"""Every query against its SQL twin on the smallest provided tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="provided tables not here")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    result = check_oracle.compare(spark, con, FOLDER, name)
    assert result.startswith(("ok", "rows only")), result
    assert not result.endswith(" 0"), "no rows to compare"


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
