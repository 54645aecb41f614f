"""Registry of named queries over the test tables.

Each entry is a function ``(spark, data_dir) -> DataFrame`` built from the
library operators, an optional ANSI SQL text computing the same rows in
DuckDB (None when the result is a fitted model or random), and the
inventory ids it exercises.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    ids: list[str] = field(default_factory=list)


REGISTRY: dict[str, Entry] = {}


def register(name: str, ids: list[str] | str, sql: str | None = None):
    """Decorator adding a query to the registry (names must be unique)."""
    if isinstance(ids, str):
        ids = ids.split()

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Entry(name, fn, sql.strip() if sql else None, list(ids))
        return fn

    return deco


def unit_sql(*keys: str, seed: int = 7) -> str:
    """SQL text of ``evaluate.hash_unit``: md5 text to a number in [0, 1)."""
    text = ", ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"(CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 8) AS BIGINT) / 4294967296.0)"


def load_all() -> dict[str, Entry]:
    """Import every plan module so its queries register."""
    from tessera.plans import (  # noqa: F401
        basket_plans,
        relational_plans,
        ordered_plans,
        scalar_plans,
        stats_plans,
        text_plans,
        model_prep_plans,
        model_plans,
        tree_plans,
        sweep_plans,
        learned_plans,
    )
    return REGISTRY
