"""Rounding, guarded ratios and exact means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(value: Column, digits: int = 2) -> Column:
    """Round a double by scaling in binary, half away from zero.

    ``F.round`` rounds the shortest decimal text of the double instead, which
    differs on values such as 1.005.
    """
    factor = float(10 ** digits)
    return F.round(value * F.lit(factor)) / F.lit(factor)


def ratio(part: Column, whole: Column) -> Column:
    """Double division, NULL on a zero divisor."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def percentage(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole`` with two digits, NULL on a zero whole."""
    return round_scaled(part.cast("double") * F.lit(100.0)
                        / F.nullif(whole, F.lit(0)).cast("double"))


def whole_number(value: Column, kind: str = "bigint") -> Column:
    return F.round(value).cast(kind)


def hundredths(value: Column) -> Column:
    """A two-digit decimal as an exact long, so that sums do not depend on their order."""
    return (value * F.lit(100)).cast("bigint")


def mean_of_hundredths(total: Column, count: Column) -> Column:
    """The rounded mean of two-digit decimals: one division of exact numbers."""
    return round_scaled(total.cast("double") / F.nullif(count * F.lit(100), F.lit(0)).cast("double"))


def share_label(part: Column, whole: Column) -> Column:
    """The percentage as text with a percent sign; a NULL ratio leaves the bare sign."""
    return F.concat_ws("", percentage(part, whole).cast("string"), F.lit("%"))
