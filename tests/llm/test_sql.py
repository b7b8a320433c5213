"""Queries that SQL can express against their DuckDB SQL."""

import pytest

from siltstone.llm.oracle import ORACLE
from siltstone.llm.queries import QUERIES
from testbed.check import connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op3_decontaminate", "op6_quality", "op9_chats"])
def test_query_equals_sql(spark, name):
    relation = connect(SF).sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(relation.columns)
    rows = sorted(map(tuple, got.select(*relation.columns).collect()), key=str)
    assert rows == sorted(relation.fetchall(), key=str)
