"""Readers of the landed sheets and of the dimensions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.sources.kinds import widened
from tallyworks.sources.listing import exists, folders
from tallyworks.sources.schemas import (
    CODE_COLUMNS,
    LINEAGE,
    REGISTRY_COLUMNS,
    SHEET_COLUMNS,
    TARGET_SHEETS,
    header_schema,
    landed_schema,
)


def english(df: DataFrame, columns: Iterable[tuple]) -> DataFrame:
    """Rename header text to the English names."""
    return df.withColumnsRenamed({header: name for header, name, _ in columns})


#: Columns found in a day: lower-case key, spelling, kinds of values (bits) and numbers of cells.
FOUND = "array<struct<key:string,header:string,kinds:int,cells:long>>"
#: First and last date of a landed log day's samples, by kind; NULL where it was not looked for.
SPANS = "array<struct<kind:string,first:date,last:date>>"
LANDINGS = (f"_sheet string, _dt string, _file string, row_count long, rejected long, columns {FOUND}, spans {SPANS}, "
            "_ingest_ts long, _run long")


def latest_landings(spark: SparkSession, lake: str) -> DataFrame:
    """What the latest landing of each sheet and day counted and found."""
    if not exists(spark, f"{lake}/_landings"):
        return spark.createDataFrame([], LANDINGS)
    log = spark.read.schema(LANDINGS).parquet(f"{lake}/_landings").filter(F.col("_file").isNotNull())
    last = F.max_by(F.struct("_file", "row_count", "rejected", "columns", "spans", "_ingest_ts", "_run"), F.struct("_ingest_ts", "_run")).alias("last")
    return log.groupBy("_sheet", "_dt").agg(last).select("_sheet", "_dt", "last.*")


def column_catalogue(spark: SparkSession, lake: str) -> DataFrame:
    """The columns found in each landed sheet and day: lower-case ``key``, ``header``, ``kinds`` of values (bits) and ``cells``."""
    return latest_landings(spark, lake).select("_sheet", "_dt", "_file", F.explode("columns").alias("c")).select("_sheet", "_dt", "_file", "c.*")


def log_spans(spark: SparkSession, lake: str, sheet: str = "MON_LOG") -> DataFrame:
    """Landed days of a log whose dates were recorded with them, and their spans."""
    return latest_landings(spark, lake).filter((F.col("_sheet") == sheet) & F.col("spans").isNotNull()).select("_dt", "spans")


def undeclared_columns(spark: SparkSession, lake: str, sheets: Iterable[str]) -> dict[str, list[tuple[str, str]]]:
    """(header, type) of the landed columns without a declared type, by sheet: the type holds the values of all days."""
    sheets = list(sheets)
    found = column_catalogue(spark, lake).filter(F.col("_sheet").isin(*sheets)).groupBy("_sheet", "key").agg(
        F.min("header").alias("header"), F.bit_or("kinds").alias("kinds")).orderBy("_sheet", "key").collect()  # a row a column
    known = {sheet: {header.lower() for header, _, _ in SHEET_COLUMNS.get(sheet, [])} for sheet in sheets}
    columns: dict[str, list[tuple[str, str]]] = {sheet: [] for sheet in sheets}
    for row in found:
        if row["key"] not in known[row["_sheet"]]:
            columns[row["_sheet"]].append((row["header"], widened(row["kinds"])))
    return columns


def sheet_schema(sheet: str, undeclared: Iterable[tuple[str, str]] = ()) -> T.StructType:
    """Declared columns under their headers, lineage, then undeclared columns, which land as text."""
    fields = landed_schema(sheet).fields if sheet in SHEET_COLUMNS else LINEAGE
    return T.StructType([*fields, *[T.StructField(header, T.StringType()) for header, _ in undeclared]])


def named(df: DataFrame, sheet: str, undeclared: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """A landed sheet under English names; undeclared columns keep their header (one that is an English or
    lineage name is marked as a cell) and take their type."""
    undeclared = list(undeclared)
    if not undeclared:
        return english(df, SHEET_COLUMNS.get(sheet, ()))
    new = {header: name for header, name, _ in SHEET_COLUMNS.get(sheet, ())}
    columns = [f.name for f in sheet_schema(sheet)]
    taken = {new.get(c, c).lower() for c in columns}
    own = [F.col(quoted(c)).alias(new.get(c, c)) for c in columns]
    rest = [F.col(quoted(h)).try_cast(to).alias(f"{h}_cell" if h.lower() in taken else h) for h, to in undeclared]
    return df.select(*own, *rest)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_sheet(spark: SparkSession, lake: str, sheet: str, fmt: str = "parquet",
               undeclared: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """One landed sheet: declared columns, lineage, and whatever else the catalogue knows of it. A day that lacks a column has NULL
    there; ``_sheet`` and ``_dt`` come from the folders.

    JSON-lines folders may be gzip text (one task per file). The Parquet copy
    splits and prunes columns.
    """
    if undeclared is None:
        undeclared = undeclared_columns(spark, lake, [sheet])[sheet]
    source = spark.read.schema(sheet_schema(sheet, undeclared)).format(fmt).option("basePath", lake)
    return named(source.load(f"{lake}/_sheet={sheet}"), sheet, undeclared)


def read_flat_sheet(spark: SparkSession, glob: str, sheet: str, inferred: bool = False) -> DataFrame:
    """JSON-lines files named by glob, with the lineage inside each record. ``inferred`` adds the columns
    without a declared type, of the type that holds their values in all files (a pass over them)."""
    declared = landed_schema(sheet)
    if not inferred:
        return english(spark.read.schema(declared).json(glob), SHEET_COLUMNS[sheet])
    known = {f.name.lower() for f in declared}
    extra = [f for f in spark.read.json(glob).schema if f.name.lower() not in known]
    return english(spark.read.schema(T.StructType([*declared.fields, *extra])).json(glob), SHEET_COLUMNS[sheet])


def read_codes(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """The code dimension: UTF-8, header, tab-separated."""
    df = spark.read.csv(path, sep=sep, header=True, schema=header_schema(CODE_COLUMNS))
    return english(df, CODE_COLUMNS)


def read_delimited(spark: SparkSession, path: str, typed: bool = False) -> DataFrame:
    """A delimited text table passed through; the separator is found in the header line.

    With ``typed``, columns whose values are all whole numbers, decimals, dates or times read as such: one more pass over
    the file. Whole numbers are 64 bits wide, whatever values a file happens to hold.
    """
    header = spark.read.text(path).limit(1).collect()
    line = header[0][0] if header else ""
    sep = max(("\t", ",", ";", "|"), key=line.count)
    df = spark.read.csv(path, sep=sep, header=True, inferSchema=typed)
    widths = {"int": "bigint", "timestamp": "timestamp_ntz"}
    types = [(f.name, widths.get(f.dataType.simpleString())) for f in df.schema]
    return df.select(*[F.col(quoted(name)).cast(wide).alias(name) if wide else F.col(quoted(name)) for name, wide in types])


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(header_schema(REGISTRY_COLUMNS)).json(path)
    return english(df, REGISTRY_COLUMNS)


def open_lake(spark: SparkSession, lake: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The sheets found in the lake, keyed by lower-case sheet name."""
    found = {sheet for (sheet,) in folders(spark, lake, "_sheet")}
    sheets = [sheet for sheet in TARGET_SHEETS if sheet in found]
    undeclared = undeclared_columns(spark, lake, sheets)
    return {sheet.lower(): read_sheet(spark, lake, sheet, fmt, undeclared[sheet]) for sheet in sheets}


def write_days(df: DataFrame, lake: str, fmt: str = "parquet") -> None:
    """One file set per sheet and day. Days present in ``df`` are replaced, all others
    left alone, so writing a day again after a failure is harmless.

    The write is narrow: input files are per day, so tasks already hold few days
    and a hot day is written by as many tasks as read it.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false").option("compression", "gzip")
    writer.partitionBy("_sheet", "_dt").format(fmt).save(lake)


def compact(spark: SparkSession, lake: str, sheet: str, target: str) -> DataFrame:
    """Copy one JSON sheet to Parquet with the record of its days, so later scans split and prune."""
    source = spark.read.schema(sheet_schema(sheet, undeclared_columns(spark, lake, [sheet])[sheet])).option("basePath", lake)
    rows = source.json(f"{lake}/_sheet={sheet}")
    # each day goes to one task, and a day that holds far more rows than others is split
    write_days(rows.hint("rebalance", F.col("_sheet"), F.col("_dt")), target)
    if exists(spark, f"{lake}/_landings"):
        latest_landings(spark, lake).filter(F.col("_sheet") == sheet).coalesce(1).write.mode("append").parquet(f"{target}/_landings")
    return read_sheet(spark, target, sheet)


def with_lineage(df: DataFrame, file, sheet: str, dt, ingest_ts: int) -> DataFrame:
    return df.withColumns({"_file": file, "_sheet": F.lit(sheet), "_dt": dt,
                           "_ingest_ts": F.lit(ingest_ts).cast("bigint")})
