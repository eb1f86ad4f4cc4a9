"""Every registered query against its SQL, and the rules that plans must keep."""

import pytest

import __spark_entry__ as entry
import compare
from tidemark import catalog

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_gives_the_answer_of_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
        return
    assert compare.type_gaps(df, con, sql) == {}
    assert compare.spark_answer(df) == compare.sql_answer(con, sql)


def test_flagship(spark):
    assert entry.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - {"follow_remote", "follow_local", "follow_local_documents"}))
def test_no_plan_multiplies_rows_or_gathers_a_table(spark, name):
    """One task may only receive what was reduced before: partial aggregates, limits, sizes of partitions."""
    plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.split("\n")
    for exchange, child in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in exchange:
            assert "partial_" in child or "LocalLimit" in child or (name == "assign_batches" and "_part" in child)
