"""Driver contract and oracle agreement of every registered query (sf0.001)."""

import os

import pytest

from tessera.plans.catalog import load_all

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

REG = load_all()


def test_entry_contract(spark):
    import importlib.util
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0
    assert set(mod.oracle_sql()) <= set(mod.queries())


@pytest.fixture(scope="module")
def con():
    from tests.oracle_compare import duck
    return duck(SF)


@pytest.mark.parametrize("name", sorted(n for n, e in REG.items() if e.sql))
def test_oracle(spark, con, name):
    from tests.oracle_compare import compare
    e = REG[name]
    r = compare(spark, con, name, e.fn, e.sql, SF)
    assert r["status"] in ("EXACT", "CLOSE"), r
