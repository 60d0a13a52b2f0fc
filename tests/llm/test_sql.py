import pytest

from tidemark.llm.queries import ORACLE, QUERIES


def test_names():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(name, same_as_sql):
    same_as_sql(QUERIES[name], ORACLE[name])
