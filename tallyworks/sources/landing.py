"""Landing: decoded sheet rows to one lake table per sheet, partitioned by file day.

The inbox holds the decoded rows by sheet and workbook name::

    inbox/_sheet=RT_CNT/_file=daily-20260401.xlsx/part-*.json

Which workbooks to land is decided on folder names and the lake's own record of
landed days; no content is read for it. Cells are read as they are, whatever their
headers, and normalised by value; what a declared type cannot hold and lines that cannot
be read are kept in ``_rejected`` and counted in ``_landings``; the columns found, with the kinds of their
values, are recorded with the day, from where the readers take undeclared columns.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions import calendar
from tallyworks.session import at_once, scratch_dir
from tallyworks.sources import kinds
from tallyworks.sources.lake import FOUND, SPANS, latest_landings, with_lineage, write_days
from tallyworks.sources.listing import exists, folder_paths, folders, remove
from tallyworks.sources.schemas import SHEET_COLUMNS, TARGET_SHEETS, header_schema

# any workbook name that ends in an 8-digit day
FILE_PATTERN = r"^.*?(\d{8})\.xlsx$"
FILES = "_sheet string, _file string"
LANDED = "_sheet string, _dt string"
LANDING_LOG = "_sheet string, _dt string, _file string, row_count long, rejected long, _ingest_ts long"
COUNTED = ("_file", "row_count", "rejected", "columns", "spans", "_ingest_ts", "_run")
# The sheet with monitor samples, and the headers and kinds by which its days are found again.
LOG_SHEET, LOG_HEADERS, LOG_KINDS = "MON_LOG", ("MONITOR_KIND", "TARGET_IP", "CREATETIME"), ("SERVER", "JVM")
REJECTED = "_file string, header string, content string, _ingest_ts long, _sheet string, _dt string"
INTERNAL = ("_file", "_sheet", "_dt", "_ingest_ts")
#: What a failed read or write raises: Spark's own errors, and those of a job that failed.
FAILURES = (PySparkException, Py4JJavaError)
#: Sheets land at the same time, but two appends to one folder would share their temporary files.
RECORDING = threading.Lock()


class LandingFailed(RuntimeError):
    """Some sheets could not be landed; the others are."""

    def __init__(self, failures: list[str]):
        super().__init__("landing completed with failures: " + "; ".join(failures))
        self.failures = failures


def select_files(df: DataFrame, pattern: str = FILE_PATTERN, date: str | None = None,
                 newest: int | None = None) -> DataFrame:
    """Rows of files whose whole name matches; ``_dt`` is the captured day.

    ``newest`` keeps the last N file names, after the date restriction.
    """
    whole = pattern if pattern.startswith("^") else f"^(?:{pattern})$"
    chosen = df.filter(F.col("_file").rlike(whole))
    chosen = chosen.withColumn("_dt", F.regexp_extract("_file", whole, 1))
    if date and date.strip():
        chosen = chosen.filter(F.col("_dt") == date.strip())
    if newest is not None and newest > 0:
        last = chosen.select("_file").distinct().orderBy(F.desc("_file")).limit(newest)
        chosen = chosen.join(last, "_file", "left_semi")
    return chosen


def route(df: DataFrame, sheets: Sequence[str] = TARGET_SHEETS) -> DataFrame:
    """Rows of the sheets that have a lake table."""
    return df.filter(F.col("_sheet").isin(*sheets))


def clean_headers(names: Iterable[str]) -> list[str]:
    """Trimmed headers; blank ones become ``column_<position>``."""
    return [(name or "").strip() or f"column_{i}" for i, name in enumerate(names)]


def with_clean_headers(df: DataFrame, headers: Sequence[str] | None = None) -> DataFrame:
    """Columns under cleaned headers. Of equal headers the last one's value stays, in
    the first one's place."""
    names = clean_headers(headers if headers is not None else df.columns)
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    last = {name: i for i, name in enumerate(names)}
    return plain.select(*[F.col(f"c{last[name]}").alias(name) for name in dict.fromkeys(names)])


def _data_columns(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema if f.name not in ("_file", "_sheet", "_dt", "_ingest_ts")]


def _blank(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return value.isNull() | value.rlike(r"^\s*$")
    return value.isNull()


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows whose cells are all missing or whitespace."""
    fields = _data_columns(df)
    if not fields:
        return df
    all_blank = _blank(fields[0])
    for field in fields[1:]:
        all_blank = all_blank & _blank(field)
    return df.filter(~all_blank)


def normal_value(field: T.StructField) -> Column:
    """One cell column as landed: blank text to NULL, whole numbers without a
    fraction, midnight stamps as a date and other stamps as ISO text."""
    value, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.StringType):
        out = F.when(~value.rlike(r"^\s*$"), value)
    elif isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        number = value.cast("double")
        whole = (number == F.floor(number)) & (F.abs(number) < 9.0e18)
        out = F.when(whole, number.try_cast("bigint").cast("string")).otherwise(number.cast("string"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        stamp = value.cast("timestamp_ntz")
        day = stamp.cast("date")
        shown = stamp.cast("string")
        text = F.concat(F.replace(F.substring(shown, 1, 19), F.lit(" "), F.lit("T")), F.lit("."),
                        F.rpad(F.substring(shown, 21, 6), 6, "0"))
        out = F.when(day.cast("timestamp_ntz") == stamp, day.cast("string")).otherwise(text)
    elif isinstance(kind, T.DateType):
        out = value.cast("string")
    else:
        out = value
    return out.alias(field.name)


def normalise(df: DataFrame, types: T.StructType | None = None) -> DataFrame:
    """All cell columns normalised; columns with a declared type are cast to it."""
    declared = {f.name: f.dataType for f in types} if types is not None else {}
    columns = []
    for field in df.schema:
        if field.name in ("_file", "_sheet", "_dt", "_ingest_ts"):
            columns.append(F.col(field.name))
        elif field.name in declared:
            columns.append(normal_value(field).cast(declared[field.name]).alias(field.name))
        else:
            columns.append(normal_value(field))
    return df.select(*columns)


def prepare(rows: DataFrame, sheet: str, ingest_ts: int, types: T.StructType | None = None) -> DataFrame:
    """Selected raw rows of one sheet as landed: no blank rows, normal values, lineage."""
    body = normalise(drop_blank_rows(rows), types)
    return with_lineage(body, F.col("_file"), sheet, F.col("_dt"), ingest_ts)


def inbox_files(spark: SparkSession, inbox: str, sheets: Sequence[str] = TARGET_SHEETS) -> DataFrame:
    """``(_sheet, _file)`` of the decoded workbooks; a workbook may lack any sheet."""
    return route(spark.createDataFrame(folders(spark, inbox, "_sheet", "_file"), FILES), sheets)


def landed_days(spark: SparkSession, lake: str) -> DataFrame:
    """``(_sheet, _dt)`` pairs recorded as landed."""
    if not exists(spark, f"{lake}/_landings"):
        return spark.createDataFrame([], LANDED)
    return spark.read.schema(LANDED).parquet(f"{lake}/_landings").distinct()


def record_days(days: DataFrame, lake: str) -> None:
    """Record days (with what was counted and the columns found) after their rows are committed. A run lost in
    between lands the same days again, which replaces them."""
    counted = [c for c in COUNTED if c in days.columns]
    days.select("_sheet", "_dt", *counted).coalesce(1).write.mode("append").parquet(f"{lake}/_landings")


def landing_log(spark: SparkSession, lake: str) -> DataFrame:
    """Rows and rejected cells or lines per sheet, day and workbook of the day's latest landing."""
    return latest_landings(spark, lake).drop("columns", "spans", "_run")


def rejected_cells(spark: SparkSession, lake: str) -> DataFrame:
    """Cells that their column's type cannot hold, and unreadable lines (without a header)."""
    if not exists(spark, f"{lake}/_rejected"):
        return spark.createDataFrame([], REJECTED)
    return spark.read.schema(REJECTED).parquet(f"{lake}/_rejected")


def mark_todo(files: DataFrame, landed: DataFrame | None) -> DataFrame:
    """Per sheet and file whether it is to be landed: in incremental mode, when its
    sheet and day are not in the lake yet; with no ``landed`` (forced), always. Of two
    workbooks of one sheet and day the first by name is landed."""
    first = F.row_number().over(Window.partitionBy("_sheet", "_dt").orderBy("_file")) == 1
    if landed is None:
        return files.withColumn("todo", first)
    known = landed.select("_sheet", "_dt", F.lit(True).alias("_known")).distinct()
    marked = files.withColumn("_first", first).join(known, ["_sheet", "_dt"], "left")
    return marked.withColumn("todo", F.col("_first") & F.col("_known").isNull()).drop("_known", "_first")


def file_outcomes(marked: DataFrame) -> DataFrame:
    """Per file: sheets landed, and whether it was processed or skipped as a whole."""
    outputs = F.count(F.when(F.col("todo"), 1))
    return marked.groupBy("_file").agg(outputs.alias("outputs"), (outputs > 0).alias("processed"))


def landing_summary(landed: DataFrame) -> DataFrame:
    """Rows and source files per sheet and day."""
    return landed.groupBy("_sheet", "_dt").agg(F.count(F.lit(1)).alias("row_count"),
                                               F.count_distinct("_file").alias("file_count"))


def cell_schema(sheet: str) -> T.StructType:
    """Decoded cells of a known sheet: a workbook holds every number as a double."""
    numbers = (T.LongType, T.IntegerType)
    return T.StructType([T.StructField(header, T.DoubleType() if isinstance(kind, numbers) else kind)
                         for header, _, kind in SHEET_COLUMNS[sheet]])


def text_schema(headers: Iterable[str]) -> T.StructType:
    """All-text cells, for sheets whose columns are not known beforehand."""
    return T.StructType([T.StructField(name, T.StringType()) for name in dict.fromkeys(clean_headers(headers))])


#: Characters that a regular expression's \\s matches, which surround headers and make blank cells.
BLANKS = " \t\n\x0b\x0c\r"


def once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _opened(cell: Column) -> Column:
    """Header, JSON kind, and the number or else the text of a cell; whole numbers are no fractions in JSON."""
    fraction = cell["json"].startswith("D") | cell["json"].startswith("F")
    return F.struct(cell["header"].alias("header"), cell["json"].alias("json"),
                    F.when(fraction, F.try_variant_get(cell["value"], "$", "double")).alias("number"),
                    F.when(~fraction, F.try_variant_get(cell["value"], "$", "string")).alias("text"))


def _spelled(cell: Column) -> Column:
    """Header, text and kind (unless it depends on the text): whole numbers lose their fraction, blank text is NULL."""
    number, text = cell["number"], cell["text"]
    whole = (number == F.floor(number)) & (F.abs(number) < 9.0e18)
    plain = F.coalesce(number.cast("string"), F.when(F.ltrim(text, F.lit(BLANKS)) != "", text))
    kind = F.when(whole, F.lit(kinds.LONG)).when(number.isNotNull(), F.lit(kinds.DOUBLE)).when(cell["json"] == "BIGINT", F.lit(kinds.LONG)).when(
        cell["json"] == "BOOLEAN", F.lit(kinds.BOOLEAN))
    return F.struct(cell["header"].alias("header"), F.when(whole, number.cast("bigint").cast("string")).otherwise(plain).alias("text"), kind.alias("kind"))


def decoded(spark: SparkSession, paths: Sequence[str], root: str) -> DataFrame:
    """``_file``, ``cells`` and ``line`` of workbook folders: a map of each cell's landed header, text and kind by
    lower-case header; for a line that is no JSON object, NULL and the line. Headers are cleaned, blank ones take their position, of equal
    ones the last counts. Each line is parsed once and each of its cells is visited once a step, whatever the number of columns."""
    lines = spark.read.schema("value string, _file string").option("basePath", root).text(list(paths))

    def raw(entry: Column, place: Column) -> Column:
        name = F.btrim(entry["key"], F.lit(BLANKS))
        return F.struct(F.when(name == "", F.concat(F.lit("column_"), place)).otherwise(name).alias("header"),
                        F.schema_of_variant(entry["value"]).alias("json"), entry["value"].alias("value"))

    def keyed(cell: Column) -> Column:
        key, header = F.lower(cell["header"]), cell["header"]
        landed = F.when(key.isin(*INTERNAL), F.concat(header, F.lit("_cell"))).otherwise(header)
        kind = F.when(cell["text"].isNull(), F.lit(0)).otherwise(F.coalesce(cell["kind"], kinds.of_text(cell["text"])))
        return F.struct(key.alias("key"), F.struct(landed.alias("header"), cell["text"].alias("text"), kind.alias("kind")).alias("cell"))

    def last_of_each(cells: Column) -> Column:
        names = F.transform(cells, lambda c: c["key"])
        later = F.filter(cells, lambda c, i: ~F.array_contains(F.slice(names, i + 2, F.size(cells)), c["key"]))
        return F.map_from_entries(F.when(F.size(F.array_distinct(names)) == F.size(names), cells).otherwise(later))

    entries = F.map_entries(F.from_json("value", "map<string,variant>"))
    for step in (raw, _opened, _spelled, keyed):
        entries = F.transform(entries, step)
    cells = once(entries, last_of_each)
    rows = lines.filter(F.ltrim("value", F.lit(BLANKS)) != "").select("_file", "value", cells.alias("cells"))
    return rows.select("_file", "cells", F.when(F.col("cells").isNull(), F.col("value")).alias("line"))


def staged(spark: SparkSession, inbox: str, sheet: str, paths: Sequence[str], pattern: str) -> DataFrame:
    """The decoded rows of some workbooks as a written table, so that no line is parsed again; blank rows are left out on reading."""
    rows = select_files(decoded(spark, paths, f"{inbox}/_sheet={sheet}"), pattern)
    path = scratch_dir(spark, f"staged-{sheet}")
    rows.write.parquet(path)
    table = spark.read.schema(rows.schema).parquet(path)
    return table.filter(F.col("cells").isNull() | F.exists(F.map_values("cells"), lambda c: c["text"].isNotNull()))


def cell_text(key: str, kind: T.DataType) -> Column:
    """The text of a staged cell; declared days and stamps take their ISO form. Text that is none of its declared kind stays as it is."""
    text = F.try_element_at("cells", F.lit(key))["text"]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return once(text, lambda own: F.coalesce(once(own.try_cast("timestamp_ntz"), _iso), own))
    return text


def _iso(stamp: Column) -> Column:
    shown, day = stamp.cast("string"), stamp.cast("date")
    full = F.concat(F.replace(F.substring(shown, 1, 19), F.lit(" "), F.lit("T")), F.lit("."), F.rpad(F.substring(shown, 21, 6), 6, "0"))
    return F.when(day.cast("timestamp_ntz") == stamp, day.cast("string")).otherwise(full)


def typed_cells(cells: T.StructType, types: T.StructType | None) -> dict[str, tuple[str, T.DataType, T.DataType]]:
    """Header, decoded kind and landed type (text unless declared) of the known columns, by lower-case header."""
    known = {f.name.lower(): (f.name, f.dataType, T.StringType()) for f in cells}
    for f in types or []:
        name, kind, _ = known.get(f.name.lower(), (f.name, T.StringType(), None))
        known[f.name.lower()] = (name, kind, f.dataType)
    return known


def _checked(typed: dict) -> list[tuple]:
    """Key, header, decoded kind and type of the columns whose type does not hold every text."""
    return [(key, *of) for key, of in typed.items() if not isinstance(of[2], T.StringType)]


def _misfit(to: T.DataType):
    """Whether a text is none of a type."""
    return lambda text: text.isNotNull() & text.try_cast(to).isNull()


def counted(rows: DataFrame, typed: dict) -> DataFrame:
    """Per workbook and day: rows, rejected cells and lines, and the columns found with spelling, kinds and numbers of cells.

    One aggregate over the staged rows, in which a row counts beside its cells under no header; the kinds of a column combine as bits."""
    wrong = sum((once(cell_text(key, kind), _misfit(to)).cast("int") for key, _, kind, to in _checked(typed)), F.lit(0))
    unread = F.col("cells").isNull()
    row = F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("header"), F.lit(0).alias("kind"),
                   (~unread).cast("int").alias("n"), F.when(unread, F.lit(1)).otherwise(wrong).alias("rejected"))
    columns = F.transform(F.map_entries("cells"), lambda e: F.struct(
        e["key"].alias("key"), e["value"]["header"].alias("header"), e["value"]["kind"].alias("kind"), F.lit(1).alias("n"), F.lit(0).alias("rejected")))
    empty = F.array().cast("array<struct<key:string,header:string,kind:int,n:int,rejected:int>>")
    each = rows.select("_file", "_dt", F.explode(F.concat(F.array(row), F.coalesce(columns, empty))).alias("c"))
    cells = each.groupBy("_file", "_dt", "c.key").agg(
        F.min("c.header").alias("header"), F.bit_or("c.kind").alias("kinds"), F.sum("c.n").alias("n"), F.sum("c.rejected").alias("rejected"))
    own = F.col("key").isNull()
    found = F.when(~own, F.struct("key", "header", "kinds", F.col("n").alias("cells")))
    return cells.groupBy("_file", "_dt").agg(F.max(F.when(own, F.col("n"))).alias("row_count"), F.max(F.when(own, F.col("rejected"))).alias("rejected"),
                                             F.sort_array(F.collect_list(found)).alias("columns"))


def landed_rows(rows: DataFrame, headers: dict[str, str], typed: dict, sheet: str, stamp: int) -> DataFrame:
    """Staged rows under their headers (by lower-case header), typed where declared, with lineage."""
    values = []
    for key, header in headers.items():
        _, kind, to = typed.get(key, (header, T.StringType(), T.StringType()))
        values.append(cell_text(key, kind).try_cast(to).alias(header))
    return with_lineage(rows.filter("cells IS NOT NULL").select(*values, "_file", "_dt"), F.col("_file"), sheet, F.col("_dt"), stamp)


def rejected_of(rows: DataFrame, typed: dict) -> DataFrame:
    """Workbook, day, header and content of cells that their declared type cannot hold, and unreadable lines without a header."""
    def misfit(key: str, name: str, kind: T.DataType, to: T.DataType) -> Column:
        return once(cell_text(key, kind), lambda own: F.when(_misfit(to)(own), F.struct(F.lit(name).alias("header"), own.alias("content"))))

    wrong = [misfit(*of) for of in _checked(typed)]
    line = F.struct(F.lit(None).cast("string").alias("header"), F.col("line").alias("content"))
    bad = F.when(F.col("cells").isNull(), F.array(line)).otherwise(F.array_compact(F.array(*wrong)) if wrong else F.array().cast(
        "array<struct<header:string,content:string>>"))
    return rows.select("_file", "_dt", F.explode(bad).alias("b")).select("_file", "b.header", "b.content", "_dt")


def land_workbooks(spark: SparkSession, inbox: str, lake: str, sheet: str, chosen: list[tuple[str, str]], fmt: str, *,
                   pattern: str, stamp: int, cells: T.StructType, types: T.StructType | None) -> None:
    """Land the (workbook, day) pairs of one sheet: rows, rejected cells, then the record of their days and columns.

    The days are replaced as a whole: one that has no rows any more is removed.
    """
    paths = folder_paths(spark, f"{inbox}/_sheet={sheet}", "_file")
    rows = staged(spark, inbox, sheet, [paths[file] for file, _ in chosen], pattern)
    typed = typed_cells(cells, types)
    path = scratch_dir(spark, f"counted-{sheet}")
    counted(rows, typed).write.parquet(path)
    counts = spark.read.schema(f"_file string, _dt string, row_count long, rejected long, columns {FOUND}").parquet(path)
    found = counts.select(F.explode("columns").alias("c")).groupBy("c.key").agg(F.min("c.header").alias("header")).orderBy("header").collect()
    headers = {key: name for key, (name, _, _) in typed.items()}  # declared ones first
    headers |= {row["key"]: row["header"] for row in found if row["key"] not in headers}  # as many as the sheet has columns
    wanted = spark.createDataFrame([(sheet, *pair) for pair in chosen], f"{FILES}, _dt string")
    days = wanted.join(counts, ["_file", "_dt"], "left").withColumns({
        **{c: F.coalesce(c, F.lit(0)).cast("long") for c in ("row_count", "rejected")},
        "_ingest_ts": F.lit(stamp).cast("long"), "_run": F.lit(time.time_ns())})
    write_days(landed_rows(rows, headers, typed, sheet, stamp), lake, fmt)
    if sheet == LOG_SHEET and all(isinstance(typed.get(h.lower(), (0, 0, 0))[2], T.StringType) for h in LOG_HEADERS):
        spans = sample_spans(spark, lake, fmt, [day for _, day in chosen])
        days = days.join(spans, "_dt", "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))
    empty = days.filter("row_count = 0 OR rejected = 0").select("_dt", "row_count", "rejected").collect()  # at most a row a workbook
    if len([d for d in empty if d.rejected == 0]) < len(chosen):
        write_days(with_lineage(rejected_of(rows, typed), F.col("_file"), sheet, F.col("_dt"), stamp), f"{lake}/_rejected")
    earlier = exists(spark, f"{lake}/_rejected/_sheet={sheet}")
    for day in empty:
        if not day.row_count:
            remove(spark, f"{lake}/_sheet={sheet}/_dt={day._dt}")
        if not day.rejected and earlier:
            remove(spark, f"{lake}/_rejected/_sheet={sheet}/_dt={day._dt}")
    with RECORDING:
        record_days(days, lake)


def sample_spans(spark: SparkSession, lake: str, fmt: str, days: Sequence[str]) -> DataFrame:
    """First and last date of the samples of some landed log days, by kind: a narrow pass over what was just written, in place of one over
    all history in every later report."""
    kind, host, time_of = LOG_HEADERS
    rows = spark.read.schema(", ".join(f"{h} string" for h in (*LOG_HEADERS, "_sheet", "_dt"))).format(fmt).load(lake)
    rows = rows.filter((F.col("_sheet") == LOG_SHEET) & F.col("_dt").isin(list(days)) & (F.col(host) != "") & F.col(kind).isin(*LOG_KINDS))
    date = calendar.loose_stamp(F.col(time_of)).cast("date")
    each = rows.groupBy("_dt", F.col(kind).alias("kind")).agg(F.min(date).alias("first"), F.max(date).alias("last"))
    return each.groupBy("_dt").agg(F.sort_array(F.collect_list(F.struct("kind", "first", "last"))).alias("spans"))


def land_contained(spark: SparkSession, inbox: str, lake: str, sheet: str, chosen: list[tuple[str, str]], fmt: str,
                   **reading) -> list[str]:
    """Land the (workbook, day) pairs of one sheet, one by one if they fail together; returns what failed."""
    if not chosen:
        return []
    try:
        land_workbooks(spark, inbox, lake, sheet, chosen, fmt, **reading)
        return []
    except FAILURES as error:
        if len(chosen) == 1:
            return [f"{sheet}, {chosen[0][0]}: {error}"]
    return [x for one in chosen for x in land_contained(spark, inbox, lake, sheet, [one], fmt, **reading)]


def land(spark: SparkSession, inbox: str, lake: str, schemas: dict[str, T.StructType] | None = None, *,
         types: dict[str, T.StructType] | None = None, pattern: str = FILE_PATTERN,
         date: str | None = None, newest: int | None = None, force: bool = False, fmt: str = "parquet",
         ingest_ts: int | None = None) -> DataFrame:
    """Land the sheets of ``schemas`` (by default all target sheets); returns the outcome per file.

    Every column found is landed: as its declared type in ``types``, else as text. Incremental mode
    skips days a sheet already has; ``force`` rewrites them. Sheets are landed at the same time. A sheet that fails is landed workbook by workbook, so
    that one damaged file keeps no other from landing; the run then ends as failed. ``landing_log`` has the counts.
    """
    if schemas is None:
        schemas = {sheet: cell_schema(sheet) if sheet in SHEET_COLUMNS else T.StructType([]) for sheet in TARGET_SHEETS}
        types = {sheet: header_schema(columns) for sheet, columns in SHEET_COLUMNS.items()}
    stamp = int(time.time()) if ingest_ts is None else ingest_ts
    files = select_files(inbox_files(spark, inbox, list(schemas)), pattern, date, newest)
    marked = mark_todo(files, None if force else landed_days(spark, lake))
    marked = marked.select("_sheet", "_file", "_dt", "todo")
    # one row per workbook and sheet, as many as folders were listed; taken before the
    # writes below change what counts as landed
    decided = marked.collect()
    todo = {sheet: [(row["_file"], row["_dt"]) for row in decided if row["_sheet"] == sheet and row["todo"]]
            for sheet in TARGET_SHEETS if sheet in schemas}

    def land_sheet(sheet: str) -> list[str]:
        reading = {"pattern": pattern, "stamp": stamp, "cells": schemas[sheet], "types": (types or {}).get(sheet)}
        return land_contained(spark, inbox, lake, sheet, todo[sheet], fmt, **reading)

    sheets = [sheet for sheet, chosen in todo.items() if chosen]
    failures = [failure for of_sheet in at_once(spark, land_sheet, sheets) for failure in of_sheet]
    if failures:
        raise LandingFailed(failures)
    return file_outcomes(spark.createDataFrame(decided, marked.schema))
