from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from supplylens.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, small, name):
    assert differences(spark, connect(small), small, name, QUERIES[name], ORACLES[name]) == []


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())
