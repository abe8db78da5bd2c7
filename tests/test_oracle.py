"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from basketflow.registry import ORACLE as SQL
from basketflow.registry import QUERIES
from tests.conftest import SMALL
from tests.oracle import compare, connect, type_differences


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, con, key):
    df = QUERIES[key](spark, SMALL)
    if key not in SQL:
        assert df.count() > 0
        return
    assert compare(df, con, SQL[key]) is None
    assert type_differences(df, con, SQL[key]) == []


def test_entry_gives_a_score(spark):
    report = {r["model_name"]: r for r in entry.entry(spark).collect()}
    assert set(report) == {"popularity", "age_rules", "next_item", "ensemble"}
    assert report["popularity"]["map_at_12"] > 0
