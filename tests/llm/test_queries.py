"""The registered queries: SQL where there is one, rows and stable columns elsewhere."""

import os

import pytest

from tessera.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, sf, name):
    assert compare(spark, duck(sf), name, QUERIES[name], ORACLE_SQL[name], sf)["status"] in ("EXACT", "CLOSE")


def test_entry_lists_all(spark):
    import importlib.util
    path = os.path.join(os.path.dirname(__file__), "..", "..", "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("entry", path)
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names
