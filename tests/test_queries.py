import pytest

from seriesloom.plans import registry
from tests.comparing import same


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, sql, name):
    con, folder = sql
    assert name in registry.SQL
    same(registry.QUERIES[name](spark, folder), con.execute(registry.SQL[name]).df())


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
