import pytest

from tidemark.plans.oracles import ORACLE
from tidemark.plans.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, same_as_sql):
    same_as_sql(QUERIES[name], ORACLE[name])
