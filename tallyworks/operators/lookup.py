"""Lookups in dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

def lookup_left(df: DataFrame, dim: DataFrame, on: Column) -> DataFrame:
    """Left join without a hint: Spark broadcasts by measured size, AQE splits skewed keys."""
    return df.join(dim, on, "left")
