"""All registered queries that SQL can check, against their SQL."""

import pytest

import oracle

from plumbline.plans.all_queries import ORACLES, QUERIES


# they join rows by test_id, which the smallest table holds twice
BY_ID = {"partial_scores", "spearman_matrix"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    sf_dir = small.replace("sf0.001", "sf0.01") if name in BY_ID else small
    assert oracle.compare(spark, oracle.connect(sf_dir), sf_dir, QUERIES[name], ORACLES[name]) is None


def test_entry_returns_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
