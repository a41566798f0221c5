import pytest

import __spark_entry__ as E
from quire.plans.check import compare, duck
from quire.plans.queries import QUERIES
from tests.conftest import SF_SMALL


def test_every_query_has_an_oracle():
    """Queries of the optional training-data package may have none: their own tests hold them against brute force."""
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["source_id", "source_name", "part", "items"]
    rows = df.collect()
    assert len(rows) > 0 and all(r["source_id"] > 0 for r in rows)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, con, E.oracle_sql()[name])
    assert ok, msg
