import pytest

from pagewright.plans import registry
from pagewright.session import ship

from .oracle import DATA, connection, rows


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    ship(spark)
    got = registry.queries()[name](spark, str(DATA)).toPandas()
    wanted = connection().execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows(got) == rows(wanted)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_runs(spark, name):
    ship(spark)
    assert registry.queries()[name](spark, str(DATA)).count() >= 0


def test_every_sql_has_its_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_flagship(spark):
    ship(spark)
    assert registry.flagship(spark, str(DATA)).count() > 0
