import pytest

from sparkclassify.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    result = compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF_SMALL)
    assert result["cols_match"] and result["values_match"], result
