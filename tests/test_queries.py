import pytest

import __spark_entry__ as entry
from recordloom.plans import funnel_queries, record_queries, table_queries  # noqa: F401
from tests.compare import same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(table_queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    same(spark, entry, name, SF)


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_sorted_top_k_plans_stay_partial(spark):
    plan = table_queries.QUERIES["reserve_cap"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
