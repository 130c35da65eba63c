"""Every registered query beside its SQL, on the smallest driver tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as driver  # noqa: E402

from touchline.plans.oracle import ORACLE_SQL  # noqa: E402
from touchline.plans.queries import QUERIES  # noqa: E402

SF_DIR, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    from compare import connect

    return connect(SF_DIR)


def test_contract(spark):
    assert driver.entry(spark).count() > 0
    assert set(ORACLE_SQL) == set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, key):
    from compare import compare

    assert compare(spark, duck, key, SF_DIR) is None


@pytest.mark.parametrize("sf_dir", [SF_DIR, LARGER])
def test_every_query_compares_rows(sf_dir):
    """Equal but empty results would prove nothing, so each query's SQL finds rows at both scales."""
    from compare import connect

    duck = connect(sf_dir)
    empty = [key for key, sql in ORACLE_SQL.items() if not duck.execute(f"SELECT 1 FROM ({sql}) LIMIT 1").fetchall()]
    assert not empty


def test_a_merge_that_ignores_its_order_is_seen(spark, duck, monkeypatch):
    from compare import compare
    from touchline.operators import keyed

    honest = keyed.newest_per_key
    monkeypatch.setattr(keyed, "newest_per_key", lambda df, keys, order_by=(), oldest=False: honest(df, keys, (), oldest))
    assert compare(spark, duck, "merge_upsert", SF_DIR) is not None
