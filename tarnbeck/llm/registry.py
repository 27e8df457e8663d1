"""The queries of this subpackage, by module; the pipeline counts as one of them."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ["simhash", "packing", "pii", "licenses", "orderhash", "langid", "htmltree", "warc", "substring", "decontaminate"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in import_module(f"tarnbeck.llm.{m}").QUERIES.items()} | {"pipeline": import_module("corpus_pipeline").run}


def oracles() -> dict[str, str]:
    found = {k: q for m in MODULES for k, q in import_module(f"tarnbeck.llm.{m}").ORACLES.items()}
    whole = import_module("corpus_pipeline").ORACLE_SQL
    return found | ({"pipeline": whole} if whole else {})
