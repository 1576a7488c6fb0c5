"""Query registry: each entry pairs a Spark callable with its oracle SQL.

Callables take ``(spark, sf_dir)`` and return a DataFrame whose doubles are
rounded and whose integers are BIGINT, so that Spark and DuckDB agree on
types. ``sql`` is ``None`` for operators with no SQL equivalent (model
fitting, custom state, iterative algorithms); those get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskweave.functions.columns import round_doubles


@dataclass
class RegisteredQuery:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    digits: int
    overrides: dict[str, int]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(self.fn(spark, sf_dir), self.digits, self.overrides)


REGISTRY: dict[str, RegisteredQuery] = {}


def register(name: str, sql: str | None = None, digits: int = 6, overrides: dict[str, int] | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = RegisteredQuery(name, fn, sql, digits, overrides or {})
        return fn

    return deco


def load_all() -> dict[str, RegisteredQuery]:
    """Import every query module (registration happens at import)."""
    from riskweave.plans import (  # noqa: F401
        q_audit,
        q_eda,
        q_features,
        q_split_encode,
        q_metrics,
        q_models,
        q_anomaly,
        q_streaming,
        q_sources,
    )

    return REGISTRY
