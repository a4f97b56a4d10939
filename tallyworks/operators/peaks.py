"""Peaks as aggregates.

``max_by`` combines on the map side, where a ranking window would move and sort
every row of a group; hot groups therefore cost one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def earlier(day: Column) -> Column:
    """An ordering part that prefers the earlier date."""
    return -F.unix_date(day)


def peak(values: Column, *order: Column) -> Column:
    """The values at the greatest order; NULL order parts rank lowest."""
    return F.max_by(values, F.struct(*order))


def peak_present(values: Column, measure: Column, *order: Column) -> Column:
    """Like :func:`peak`, but rows with a NULL measure cannot win."""
    return F.max_by(F.when(measure.isNotNull(), values),
                    F.when(measure.isNotNull(), F.struct(measure, *order)))
