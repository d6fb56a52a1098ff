"""Queries of this subpackage: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_MODULES = ("langid", "lpf", "imatch", "pii", "htmltext", "brownlm", "decontaminate", "pfair", "toxicity",
            "ngramjoin", "runs", "vectortrees",
            "crosstokens")


def query(name: str, sql: str | None = None):
    """Register ``fn(table) -> DataFrame``; ``table(name)`` reads a table whole."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def all_queries() -> dict:
    for name in _MODULES:
        import_module(f"gristmill.llm.{name}")
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    all_queries()
    return dict(ORACLES)
