"""Every registered query gives the rows its SQL counterpart gives."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from compare import assert_same, duck

import __spark_entry__ as entry_points
from cartage.workload.oracles import ORACLES
from cartage.workload.queries import QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.fixture(scope="module")
def checks(spark, sf_dir):
    """All comparisons, a few at a time: most of their time goes into small jobs.

    Each query has a session of its own, so no setting leaks into another.
    """
    def check(name):
        session = spark.newSession()
        return assert_same(QUERIES[name](session, sf_dir), duck(sf_dir).execute(ORACLES[name]))

    with ThreadPoolExecutor(6) as pool:
        yield {name: pool.submit(check, name) for name in sorted(QUERIES)}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, checks):
    checks[name].result()


def test_entry_reconciles(spark):
    rows = entry_points.entry(spark).collect()
    assert rows and all(r.matched for r in rows)
