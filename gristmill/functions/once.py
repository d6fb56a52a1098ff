"""Costly columns that several expressions read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    A projected column may be copied into every expression and filter that uses
    it, also into the filter that exploding it adds; the output of a generator
    is not.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
