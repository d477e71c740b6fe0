import pytest

from gridframe.llm import queries as q
from tests.oracle import TABLES, both

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="the tables aren't here")


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    by_spark, by_sql = both(spark, q.QUERIES[name], q.ORACLE_SQL[name])
    assert by_spark == by_sql and by_spark


def test_queries_name_the_operators():
    assert [n.split("_")[0] for n in q.QUERIES] == [f"op{k}" for k in range(1, 14)]
