import pytest

from lexcurate import queries
from tests.oracle import agree


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, small, name):
    if name in queries.ORACLES:
        agree(spark, small, queries.QUERIES[name], queries.ORACLES[name])
    else:
        queries.QUERIES[name](spark, small).collect()


def test_entry(spark, small):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
