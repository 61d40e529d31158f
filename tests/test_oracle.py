"""Every registered query against its SQL answer, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from sensoria.checks import registry
from sensoria.checks.compare import differences, oracle_connection

FOLDER = "/root/testdata/sf0.001"
QUERIES = registry.QUERIES
ANSWERS = registry.ORACLE


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    result = QUERIES[name](spark, FOLDER)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    found = result.toArrow()
    if name in ANSWERS:
        expected = oracle_connection(FOLDER).sql(ANSWERS[name]).to_arrow_table()
        assert differences(found, expected) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["COD_DIS", "valor_medio"]
    assert entry.entry(spark).count() > 0


def test_answers_belong_to_queries():
    assert set(ANSWERS) <= set(QUERIES)
    assert set(QUERIES) == set(ANSWERS)


def test_entry_offers_every_registered_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ANSWERS) <= set(entry.oracle_sql())
