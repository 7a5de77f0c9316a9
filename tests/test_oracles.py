
import os

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

SF = os.environ.get("LINESTREAM_TEST_SF", "/root/testdata/sf0.001")
QUERIES = {k: v for k, v in E.queries().items() if k not in E.LLM_QUERIES}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k not in E.LLM_QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, QUERIES[name], ORACLES[name], SF, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_id", "key", "value"]
    assert df.count() > 0
