"""Driver contract: entry() on sf0.001 and every registered query against its DuckDB oracle."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from starlift.plans.catalog import ORACLE_SQL  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
ITERATIVE = {"t3_nmf_topics", "t8_topic_assignment", "t10_topic_sizes", "t11_stability_trial"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["country_canonical", "year", "month", "layoff_events", "total_laid_off",
                          "avg_percentage_laid_off"]
    assert df.count() > 0


def test_every_query_but_the_iterative_ones_has_an_oracle():
    from starlift.plans.catalog import QUERIES
    assert set(QUERIES) - set(ORACLE_SQL) == ITERATIVE
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    sdf = E.queries()[name](spark, SF)
    res = duck(SF).execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(dcols, res.fetchall())
