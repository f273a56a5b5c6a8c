import pytest

from lexcurate.llm import queries
from tests.oracle import agree


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, small, name):
    if name in queries.ORACLES:
        agree(spark, small, queries.QUERIES[name], queries.ORACLES[name])
    else:
        queries.QUERIES[name](spark, small).collect()


def test_registered():
    import __spark_entry__

    assert set(queries.QUERIES) <= set(__spark_entry__.queries())
    assert {int(n[1 : n.index("_")]) for n in queries.QUERIES} == set(range(1, 11))
