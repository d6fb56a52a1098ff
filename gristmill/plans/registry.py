"""Named queries over the test tables, each with SQL of the same meaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function ``(table) -> DataFrame``; ``table(name)`` reads a table."""
    def register(fn):
        name = fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def spread(table: DataFrame) -> DataFrame:
    """A scan with fewer splits than cores, spread over all of them.

    For work that is heavy per row on a table of one or few files; a large
    table has splits enough and stays as it is.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table if table.rdd.getNumPartitions() >= cores else table.repartition(cores)
