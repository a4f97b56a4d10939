"""Delivered CSV tables and bounded previews of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.sources.lake import quoted

BOM = "﻿"
CSV_OPTIONS = {"header": True, "nullValue": "", "emptyValue": "", "quote": '"', "escape": '"',
               "encoding": "UTF-8", "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}


def _as_text(field: T.StructField) -> Column:
    text = F.col(f"`{field.name}`").cast("string")
    if isinstance(field.dataType, T.TimestampNTZType):
        # delivered stamps always show a fraction
        return F.when(F.instr(text, ".") > 0, text).otherwise(F.concat(text, F.lit(".0")))
    return text


def labelled(df: DataFrame, labels: Mapping[str, str] | None = None, bom: bool = True) -> DataFrame:
    """Text columns under their delivered labels; the BOM rides on the first label."""
    names = [(labels or {}).get(name, name) for name in df.columns]
    if bom and names:
        names[0] = BOM + names[0]
    texts = [_as_text(field).alias(field.name) for field in df.schema]
    return df.select(*texts).toDF(*names)


def write_csv(df: DataFrame, path: str, labels: Mapping[str, str] | None = None, *,
              order: Sequence[Column] = (), bounded: bool = False, bom: bool = True) -> int:
    """Write a CSV folder and return the number of rows written.

    Rows are counted while they are written. Ordered tables are range
    partitioned, so their part files follow each other. Only a table that is
    bounded by its own definition (a top-n, a pivot, a capped export) is
    written as one part.
    """
    table = df.orderBy(*order) if order else df
    if bounded:
        table = table.coalesce(1)
    seen = Observation()
    out = labelled(table, labels, bom).observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return int(seen.get["rows"])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A written CSV folder, BOM removed; every column is text."""
    df = spark.read.options(**{**CSV_OPTIONS, "multiLine": True}).csv(path)
    return df.toDF(*[name.removeprefix(BOM) for name in df.columns])


def preview(df: DataFrame, rows: int, order: Sequence[Column] = ()) -> DataFrame:
    """The first rows, each with the total row count and whether rows were left out.

    One run of the dataset: rows are counted as they pass on to a bounded top list. Ties, and rows without an order, go by all columns.
    """
    most, seen = max(rows, 1), Observation()
    whole = [F.col(quoted(f.name)) for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    head = df.observe(seen, F.count(F.lit(1)).alias("rows")).orderBy(*order, *whole).limit(most).collect()
    total = int(seen.get["rows"])
    schema = T.StructType([*df.schema, T.StructField("total_rows", T.LongType()), T.StructField("truncated", T.BooleanType())])
    return df.sparkSession.createDataFrame([(*row, total, total > most) for row in head], schema)
