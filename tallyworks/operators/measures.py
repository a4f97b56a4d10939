"""Mergeable states of max / min / mean over two-digit decimals.

Sums are kept in exact hundredths, so states may be merged in any order and from
any finer grain (hour to day) and still give the same figures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.numbers import hundredths, mean_of_hundredths


def states(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per key: row count and, per metric, max, min, exact sum and count."""
    parts: list[Column] = [F.count(F.lit(1)).alias("record_count")]
    for name in metrics:
        value = F.col(name)
        parts += [F.max(value).alias(f"{name}__max"), F.min(value).alias(f"{name}__min"),
                  F.sum(hundredths(value)).alias(f"{name}__sum"), F.count(value).alias(f"{name}__n")]
    return df.groupBy(*keys).agg(*parts)


def merge(parts: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """States at a coarser key."""
    merged: list[Column] = [F.sum("record_count").alias("record_count")]
    for name in metrics:
        merged += [F.max(f"{name}__max").alias(f"{name}__max"), F.min(f"{name}__min").alias(f"{name}__min"),
                   F.sum(f"{name}__sum").alias(f"{name}__sum"), F.sum(f"{name}__n").alias(f"{name}__n")]
    return parts.groupBy(*keys).agg(*merged)


def mean_of(name: str) -> Column:
    return mean_of_hundredths(F.col(f"{name}__sum"), F.col(f"{name}__n"))


def max_of(name: str) -> Column:
    return F.col(f"{name}__max")


def min_of(name: str) -> Column:
    return F.col(f"{name}__min")
