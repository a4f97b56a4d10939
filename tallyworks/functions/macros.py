"""Named SQL functions, loaded into the session before reports run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

MACROS: dict[str, str] = {
    "iso_year_week": (
        "CREATE OR REPLACE TEMPORARY FUNCTION iso_year_week(d DATE) RETURNS STRING RETURN "
        "concat(extract(YEAROFWEEK FROM d), '-', lpad(weekofyear(d), 2, '0'))"
    ),
    "safe_pct": (
        "CREATE OR REPLACE TEMPORARY FUNCTION safe_pct(part DOUBLE, whole DOUBLE) RETURNS DOUBLE RETURN "
        "round(part * 100.0D / nullif(whole, 0.0D) * 100.0D) / 100.0D"
    ),
    "republic_date": (
        "CREATE OR REPLACE TEMPORARY FUNCTION republic_date(d DATE) RETURNS STRING RETURN "
        "concat(year(d) - 1911, substr(replace(string(d), '-', '/'), 5))"
    ),
    "share_text": (
        "CREATE OR REPLACE TEMPORARY FUNCTION share_text(part DOUBLE, whole DOUBLE) RETURNS STRING RETURN "
        "concat_ws('', string(round(part * 100.0D / nullif(whole, 0.0D) * 100.0D) / 100.0D), '%')"
    ),
}


def load_macros(spark: SparkSession, macros: Mapping[str, str] = MACROS) -> list[str]:
    """Run each definition in name order; returns the names loaded.

    A folder of definitions is read with :func:`tallyworks.sources.texts.sql_files`.
    """
    for name in sorted(macros):
        spark.sql(macros[name])
    return sorted(macros)
