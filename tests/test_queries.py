"""Every registered query next to its SQL, on the smallest given data set."""

from pathlib import Path

import pytest

SF_DIR = "/root/testdata/sf0.001"

if not Path(SF_DIR).exists():
    pytest.skip("no test data", allow_module_level=True)
duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from tools.check_queries import compare, duck  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == entry.queries()["conflict_ledger"](spark, SF_DIR).columns
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())
