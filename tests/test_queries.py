"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_results import compare, connect  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, DATA, name)
    assert ok, note


def test_entry_has_rows_and_a_stable_schema(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["det_id", "t_idx", "utc"]
    assert df.count() == 2 * 720


def test_every_sql_text_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
