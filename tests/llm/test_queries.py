import pytest

from brandbook.llm import queries
from tests import oracle

pytestmark = pytest.mark.skipif(not oracle.DATA.exists(), reason="the driver's tables aren't here")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs_and_equals_sql(spark, name):
    if name in queries.ORACLE_SQL:
        oracle.assert_equal(spark, queries.QUERIES[name], queries.ORACLE_SQL[name])
    else:
        assert queries.QUERIES[name](spark, str(oracle.DATA)).count() > 0
