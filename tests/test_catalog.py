"""Every registered query against its DuckDB oracle (or rows-only) on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, SF, name, E.queries()[name], E.oracle_sql().get(name), con)
    assert ok, msg


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "doc_id", "score", "pos"]
    assert df.count() == 20 * spark.read.parquet(f"{SF}/benchmark.parquet").count()
