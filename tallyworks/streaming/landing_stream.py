"""Incremental landing as a file stream: what arrives decides which workbooks are landed, each as a whole."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyworks.sources.landing import (
    FILE_PATTERN,
    LandingFailed,
    inbox_files,
    land_contained,
    landed_days,
    landing_log,
    select_files,
)

#: Rows of binary files; the content is never read.
ARRIVED = "path string, modificationTime timestamp, length long, content binary, _file string"


def arrivals(spark: SparkSession, inbox: str, sheet: str, pattern: str = FILE_PATTERN) -> DataFrame:
    """``_file`` and ``_dt`` of every file that arrives for one sheet, empty ones included, as a stream."""
    files = spark.readStream.schema(ARRIVED).format("binaryFile").load(f"{inbox}/_sheet={sheet}")
    return select_files(files.select("_file"), pattern)


def touched_workbooks(spark: SparkSession, inbox: str, lake: str, sheet: str, days: DataFrame, pattern: str) -> list[tuple[str, str]]:
    """(workbook, day) to land for the days that files arrived for: the workbook that the day was landed from, or
    else the first by name, as in batch landing. A day landed before keeps its workbook, so none of its rows go."""
    files = select_files(inbox_files(spark, inbox, [sheet]), pattern).join(days, "_dt", "left_semi")
    log = landing_log(spark, lake).filter(F.col("_sheet") == sheet).select("_dt", F.col("_file").alias("_from"))
    known = landed_days(spark, lake).filter(F.col("_sheet") == sheet).select("_dt").join(log, "_dt", "left")
    own = F.max(F.when(F.col("_file") == F.col("_from"), F.col("_file")))
    chosen = files.join(known, "_dt", "left").groupBy("_dt").agg(F.coalesce(own, F.min("_file")).alias("_file"))
    return [(row["_file"], row["_dt"]) for row in chosen.orderBy("_dt").collect()]  # one row per day that was touched


def land_available(spark: SparkSession, inbox: str, lake: str, sheet: str, schema: T.StructType,
                   checkpoint: str, *, types: T.StructType | None = None, pattern: str = FILE_PATTERN) -> StreamingQuery:
    """Land everything that is new into the lake and stop. The checkpoint remembers files across
    runs. A workbook that any file arrived for is landed whole, with every column, rejected cells and the record of its day, as
    batch landing does; so a late part file adds to its day, and a batch that is run again after a crash changes nothing. Of
    two workbooks of one day the one that was landed first stays, of those of one batch the first by name.
    """
    def land_touched(batch: DataFrame, _: int) -> None:
        own = batch.sparkSession
        chosen = touched_workbooks(own, inbox, lake, sheet, batch.select("_dt").distinct(), pattern)
        reading = {"pattern": pattern, "stamp": int(time.time()), "cells": schema, "types": types}
        failures = land_contained(own, inbox, lake, sheet, chosen, "parquet", **reading)
        if failures:
            raise LandingFailed(failures)

    query = (arrivals(spark, inbox, sheet, pattern).writeStream.foreachBatch(land_touched)
             .option("checkpointLocation", f"{checkpoint}/{sheet}").trigger(availableNow=True).start())
    query.awaitTermination()
    return query
