"""Reading, word rules and written intermediates shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.session import scratch_dir

#: Java regex of what separates words: space and the five ASCII controls from tab to carriage return.
GAP = r"[\x20\x09-\x0D]"
GAP_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text as an array; empty for null and for text without a word."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP + "+"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas inside refer to it."""
    return F.transform(F.array(value), body)[0]


def with_new(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns; an input column of the same name (in any letter case) gives way."""
    lower = {c.lower() for c in columns}
    return df.select(*[F.col(quoted(c)) for c in df.columns if c.lower() not in lower],
                     *[v.alias(k) for k, v in columns.items()])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
