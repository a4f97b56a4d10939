"""Kinds of values as bits, so that the kinds of a column combine by a bitwise or over rows, days and sheets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG, DOUBLE, BOOLEAN, DATE, STAMP, TEXT = 1, 2, 4, 8, 16, 32


def of_text(text: Column) -> Column:
    """Whether text is a day, a stamp in ISO form, or other text."""
    dashes = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    size = F.length(text)
    day = (size == 10) & dashes & text.try_cast("date").isNotNull()
    stamp = size.between(19, 26) & dashes & F.substring(text, 11, 1).isin("T", " ") & text.try_cast("timestamp_ntz").isNotNull()
    return F.when(day, F.lit(DATE)).when(stamp, F.lit(STAMP)).otherwise(F.lit(TEXT))


def widened(kinds: int) -> str:
    """The narrowest type that holds all values of some kinds: numbers widen to doubles, days to stamps, all else to text."""
    if kinds in (LONG, BOOLEAN, DATE):
        return {LONG: "bigint", BOOLEAN: "boolean", DATE: "date"}[kinds]
    if kinds and not kinds & ~(LONG | DOUBLE):
        return "double"
    if kinds and not kinds & ~(DATE | STAMP):
        return "timestamp_ntz"
    return "string"
