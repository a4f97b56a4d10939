"""Column values to columns, with a message table when there is nothing to spread."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The delivered message and its header.
MESSAGE_HEADER = "Message"


def message_table(df: DataFrame, report: str) -> DataFrame:
    text = f"No data for report {report} under current parameters"
    return df.sparkSession.createDataFrame([(text,)], f"{MESSAGE_HEADER} string")


def spread(df: DataFrame, keys: Sequence[str], column: str, measures: Sequence[Column], report: str,
           values: Sequence | None = None) -> DataFrame:
    """Pivot ``column``. Given values save the extra pass that looks for them.

    Without values Spark looks them up itself and refuses more than
    ``spark.sql.pivotMaxValues``, so the column list stays bounded.
    """
    grouped = df.groupBy(*keys)
    if values is not None:
        return grouped.pivot(column, list(values)).agg(*measures)
    table = grouped.pivot(column).agg(*measures)
    if len(table.columns) == len(keys):
        return message_table(df, report)
    return table


def conditional(measure: Column, column: str, value) -> Column:
    return F.when(F.col(column) == F.lit(value), measure)
