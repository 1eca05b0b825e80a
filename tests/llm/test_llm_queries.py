"""The queries of the subpackage, against SQL where there is any."""

import pytest
from oracle import connect, differences

import __spark_entry__ as driver
from panelwright.llm.oracles import ORACLES
from panelwright.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_there_is_one_query_per_operator_and_the_pipeline():
    names = driver.queries()
    for n in range(1, 14):
        assert len([q for q in QUERIES if q.startswith(f"op{n}_")]) == 1
    assert set(QUERIES) | {"pipeline"} <= set(names)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == []
