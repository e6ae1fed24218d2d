import pytest
from compare import differences, duck

from msgflow.llm.oracles import ORACLES
from msgflow.llm.queries import QUERIES


def test_a_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name]) == []
