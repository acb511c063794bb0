"""Every query of this subpackage that has SQL against it."""

import pytest
from compare import connect, differences

from shelfmark.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    assert differences(spark, connect(FOLDER), FOLDER, name, QUERIES[name], ORACLE[name]) == []
