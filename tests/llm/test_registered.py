import os

import pytest

import __spark_entry__ as entry
from tagloom.llm import registry
from tests.check_oracle import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", list(registry.ORACLE))
def test_query_equals_sql(spark, name):
    ok, note = compare(spark, SF, name)
    assert ok, note


def test_numbers_are_complete():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14)) and "pipeline" in entry.queries()
