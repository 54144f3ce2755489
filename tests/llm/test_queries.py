"""The queries of the subpackage against their SQL, and their registration."""

import oracle
import pytest

from clinicpulse.llm.queries import CHECKS, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(DATA)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_agrees_with_sql(spark, con, name):
    assert oracle.actual(QUERIES[name](spark, DATA)) == oracle.expected(con, CHECKS[name])


def test_driver_sees_the_queries():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(CHECKS) <= set(entry.oracle_sql()) and "pipeline" not in entry.oracle_sql()
