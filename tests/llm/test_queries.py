"""The registered queries beside their SQL."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from touchline.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, key):
    from compare import compare, connect

    assert compare(spark, connect(SF), key, SF) is None


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, len(QUERIES) + 1))
