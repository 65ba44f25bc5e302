"""Every query of the subpackage against its SQL, on the smallest tables."""

from pathlib import Path

import compare
import pytest

from talkloom.llm import queries as registry

FOLDER = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not FOLDER.is_dir(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_against_sql(spark, name):
    assert compare.compare(spark, str(FOLDER), registry.QUERIES[name], registry.SQL[name]) == ""


@pytest.mark.skipif(not FOLDER.is_dir(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_without_sql(spark, name):
    assert registry.QUERIES[name](spark, str(FOLDER)).count() > 0
