"""Query text kept in files."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def sql_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """The ``.sql`` files of a folder by name without the ending, in name order."""
    files = spark.read.text(f"{folder}/*.sql", wholetext=True)
    rows = files.select(F.col("_metadata.file_path"), "value").collect()
    named = {unquote(path.rsplit("/", 1)[-1]).removesuffix(".sql"): text for path, text in rows}
    return dict(sorted(named.items()))
