import pytest
from faunagrid.plans import registry

from tests.oracle import SF_DIR, assert_same, tables

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return tables()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert_same(con, registry.queries()[name](spark, SF_DIR).toPandas(), SQL[name])


def test_entry_points_agree():
    import __spark_entry__ as entry

    assert {*entry.oracle_sql()} <= {*entry.queries()}
    assert {*registry.queries()} <= {*entry.queries()}
