"""The queries over the reference's operators, by module."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ["analytics", "relational", "texts", "ranking", "streams"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in import_module(f"tarnbeck.plans.{m}").QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in import_module(f"tarnbeck.plans.{m}").ORACLES.items()}
