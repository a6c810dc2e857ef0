import pytest

from brandbook.plans import catalogue, catalogue_functions, catalogue_records  # noqa: F401  they register their queries
from tests import oracle

pytestmark = pytest.mark.skipif(not oracle.DATA.exists(), reason="the driver's tables aren't here")


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_equals_sql(spark, name):
    oracle.assert_equal(spark, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
