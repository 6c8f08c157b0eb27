import pytest

from pulsegrid.plans.catalog import ORACLE_SQL, QUERIES


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_sql(spark, sf_dir, same, name):
    same(QUERIES[name](spark, sf_dir), ORACLE_SQL[name])


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())


def test_projection_reads_only_its_columns(spark, sf_dir):
    plan = QUERIES["stats_by_type"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string,value:double>" in plan
