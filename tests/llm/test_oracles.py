import pytest
from oracle import compare, duck

from flowmart.llm import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, duck(sf), sf, name, QUERIES[name], ORACLE[name])[0] == ""
