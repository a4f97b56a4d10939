"""Keep the newest version of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: Sequence[str], ties: Sequence[Column | str], newest: Sequence[str] = ("_dt", "_file")) -> DataFrame:
    """One row per key: newest ``_dt``, then newest ``_file``, then the tie columns.

    The rank filter lets Spark cut every map task to one row per key before the
    shuffle (a partial group limit), so a key that holds a third of all rows
    sends at most one row per task. NULL keys form one group. The ties make the
    order total: a lost task that is run again keeps the same row.
    """
    order = [*map(F.desc, newest), *[t if isinstance(t, Column) else F.desc(t) for t in ties]]
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
