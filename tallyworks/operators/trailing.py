"""Trailing windows that end at the data's own last date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trailing_days(df: DataFrame, column: str, days: int) -> DataFrame:
    """Rows from ``days`` days before the greatest date on; rows without a date drop.

    The bound is a scalar subquery of one aggregated value, not a join.
    """
    last = df.select(F.max(F.col(column).cast("timestamp_ntz"))).scalar()
    return df.filter(F.col(column).cast("timestamp_ntz")
                     >= last - F.make_dt_interval(F.lit(days)))
