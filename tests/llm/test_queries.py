"""Queries with a SQL twin against it, on the smallest tables; the guard around the subpackage."""

import pytest

import __spark_entry__ as entry
from basketflow.llm.queries import ORACLE, QUERIES
from tests.conftest import SMALL
from tests.oracle import compare, connect, type_differences


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, key):
    con, df = connect(SMALL), QUERIES[key](spark, SMALL)
    assert compare(df, con, ORACLE[key]) is None
    assert type_differences(df, con, ORACLE[key]) == []


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names
