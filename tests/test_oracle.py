"""Every registered query against its SQL on the given tables."""

import __spark_entry__ as entry
import pytest
from compare import connect, differences

FOLDER = "/root/testdata/sf0.01"
QUERIES, ORACLE = entry.REGISTRY, entry.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(spark, con, FOLDER, name, QUERIES[name], ORACLE[name]) == []


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["appid", "game_name", "developer"]
    assert result.count() > 0
