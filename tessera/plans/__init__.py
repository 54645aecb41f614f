"""Named queries over the test tables, each paired with its DuckDB oracle SQL."""

from tessera.plans.catalog import REGISTRY, Entry, load_all, register

__all__ = ["REGISTRY", "Entry", "load_all", "register"]
