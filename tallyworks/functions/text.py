"""Codes and free-text metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_prefixes(text: Column, prefixes: Sequence[str]) -> Column:
    for prefix in prefixes:
        text = F.replace(text, F.lit(prefix), F.lit(""))
    return text


def metric(text: Column, key: str) -> Column:
    """The text after ``key:`` up to the next comma, '' when the key is absent."""
    return F.regexp_extract(text, f"{key}:([^,]+)", 1)


def rest_of_line(text: Column, key: str) -> Column:
    return F.regexp_extract(text, f"{key}:([^\\n]+)", 1)


def rate(text: Column, key: str) -> Column:
    """A percent metric as decimal(5,2). Junk, overflow and the sentinel ``N/A%``
    hold no number that fits and give NULL."""
    return F.replace(metric(text, key), F.lit("%"), F.lit("")).try_cast("decimal(5,2)")


def size(text: Column, key: str) -> Column:
    return metric(text, key).try_cast("decimal(10,2)")


def padded_code(code: Column) -> Column:
    """One letter and digits, the digits padded to four: ``G61`` gives ``G0061``."""
    letter = F.regexp_extract(code, r"^([A-Z])\d+$", 1)
    digits = F.regexp_extract(code, r"^[A-Z](\d+)$", 1)
    padded = F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits)
    return F.when(digits != "", F.concat(letter, padded)).otherwise(code)


def lines(*parts: Column) -> Column:
    """Parts joined by a line feed, NULL parts read as empty."""
    return F.concat_ws("\n", *[F.coalesce(part.cast("string"), F.lit("")) for part in parts])
