"""Every operator, dataset, report and export as a query over the driver's tables.

``QUERIES`` maps a key to a function of session and data folder; ``CHECKS`` to the
SQL that must give the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions import calendar, numbers, text
from tallyworks.functions.macros import load_macros
from tallyworks.operators.dedup import keep_latest
from tallyworks.operators.peaks import earlier, peak, peak_present
from tallyworks.operators.pivots import spread
from tallyworks.operators.trailing import trailing_days
from tallyworks.plans import batch, clean, exports, monitor, reports, rollups, stats
from tallyworks.plans.incremental import Store
from tallyworks.plans.params import run_query
from tallyworks.plans.workspace import Workspace
from tallyworks.proof import oracle, proxies
from tallyworks.session import scratch_dir
from tallyworks.sources import csvout, lake, landing
from tallyworks.sources.schemas import CODE_COLUMNS, REGISTRY_COLUMNS, SHEET_COLUMNS
from tallyworks.sources.schemas import LINEAGE as SHEET_LINEAGE
from tallyworks.streaming.landing_stream import land_available

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def add(key: str, build: Query, sql: str) -> None:
    QUERIES[key] = build
    CHECKS[key] = oracle.statement(sql)


def on(build: Callable[[Workspace], DataFrame]) -> Query:
    """A query over the sheets rebuilt from the driver's tables."""
    return lambda spark, sf_dir: build(proxies.workspace(spark, sf_dir))


def over(name: str, *columns) -> Query:
    """Columns of a dataset; a function in place of names may build expressions."""
    return on(lambda ws: ws.get(name).select(*_built(columns)))


def source(name: str, columns) -> Query:
    """Expressions over one of the driver's tables."""
    return lambda spark, sf_dir: proxies.table(spark, sf_dir, name).select(*columns())


def _built(columns) -> list:
    return columns[0]() if columns and callable(columns[0]) else list(columns)


C = F.col

# ---------------------------------------------------------------- datasets

VIEW_KEYS = {
    "v1_rt_cnt_clean": "rt_cnt_clean", "v2_rt_tmspt_clean": "rt_tmspt_clean",
    "v3_rt_pr_hh24_clean": "rt_pr_hh24_clean", "v4_rt_node_hh24_clean": "rt_node_hh24_clean",
    "v5_rt_cnt_daily": "rt_cnt_daily", "v6_rt_cnt_daily_with_tmspt": "rt_cnt_daily_with_tmspt",
    "v7_rt_cnt_weekly": "rt_cnt_weekly", "v8_rt_cnt_monthly": "rt_cnt_monthly",
    "v9_rt_cnt_monthly_without": "rt_cnt_monthly_without",
    "v10_monthly_transaction_stats": "monthly_transaction_stats", "v11_monitor_log": "monitor_log",
    "v12_monitor_daily": "monitor_daily", "v13_monitor_hourly": "monitor_hourly",
    "v14_monitor_daily_jvm": "monitor_daily_jvm", "v15_monitor_hourly_jvm": "monitor_hourly_jvm",
    "v16_pr_info": "pr_info", "v18_registry": "registry_info",
}
for _key, _dataset in VIEW_KEYS.items():
    add(_key, on(lambda ws, name=_dataset: ws.get(name)), f"SELECT * FROM {_key.split('_')[0]}")


def _passed_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "cfg")
    proxies.table(spark, sf_dir, "customer").write.csv(path, header=True)
    ws = Workspace(spark, {"cfg_codes": lake.read_delimited(spark, path)})
    return ws.get("cfg_pr_info")


add("v17_cfg_pr_info", _passed_through, "SELECT * FROM v17")


def _sniffed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "cfg")
    rows = proxies.table(spark, sf_dir, "customer").withColumn("since", F.date_add(F.lit("1990-01-01").cast("date"), C("c_nationkey")))
    rows.write.csv(path, header=True, sep=";")
    frame = lake.read_delimited(spark, path, typed=True)
    types = F.lit(",".join(f"{field.name} {field.dataType.simpleString()}" for field in frame.schema))
    return frame.withColumn("types", types)


add("v17_cfg_pr_info_typed", _sniffed, """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
       DATE '1990-01-01' + CAST(c_nationkey AS INT) AS since,
       'c_custkey bigint,c_name string,c_nationkey bigint,c_acctbal double,c_mktsegment string,since date' AS types FROM customer""")

# ---------------------------------------------------------------- scans and sinks


def with_headers(df: DataFrame, columns, extra=()) -> DataFrame:
    """English columns back under their sheet headers, as a landed file has them."""
    return df.select(*[C(name).alias(header) for header, name, _ in columns], *extra)


LINEAGE = ["_file", "_sheet", "_dt", "_ingest_ts"]


def _flat_json(sheet: str, name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_dir(spark, sheet)
        rows = proxies.workspace(spark, sf_dir).get(name)
        with_headers(rows, SHEET_COLUMNS[sheet], LINEAGE).write.json(path, compression="gzip")
        return lake.read_flat_sheet(spark, f"{path}/*.json.gz", sheet)
    return build


add("s1_json_gzip_glob_scan", _flat_json("RT_CNT", "rt_cnt"), "SELECT * FROM rt_cnt")
add("s2_json_declared_schema_scan", _flat_json("MON_LOG", "mon_log"), "SELECT * FROM mon_log")


def _codes_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "codes")
    rows = with_headers(proxies.workspace(spark, sf_dir).get("codes"), CODE_COLUMNS)
    rows.coalesce(1).write.csv(path, header=True, sep="\t")
    return lake.read_codes(spark, path)


add("s3_code_dimension_scan", _codes_file, "SELECT * FROM codes")


def _registry_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "registry")
    with_headers(proxies.workspace(spark, sf_dir).get("registry"), REGISTRY_COLUMNS).write.json(path)
    return lake.read_registry(spark, path)


add("s4_registry_scan", _registry_file, "SELECT * FROM registry")


def _json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "json-sink")
    rows = proxies.workspace(spark, sf_dir).get("mon_log")
    lake.write_days(with_headers(rows, SHEET_COLUMNS["MON_LOG"], LINEAGE), path, "json")
    return lake.read_sheet(spark, path, "MON_LOG", "json")


add("s5_json_gzip_sink", _json_sink, "SELECT * FROM mon_log")


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "compact")
    rows = proxies.workspace(spark, sf_dir).get("mon_log")
    lake.write_days(with_headers(rows, SHEET_COLUMNS["MON_LOG"], LINEAGE), f"{path}/json", "json")
    return lake.compact(spark, f"{path}/json", "MON_LOG", f"{path}/parquet")


add("s5_parquet_compaction", _compacted, "SELECT * FROM mon_log")


def _csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    page = proxies.workspace(spark, sf_dir).get("monthly_transaction_stats")
    csvout.write_csv(page, path, order=[F.asc("ym"), F.desc("category"), F.desc("total_cnt"), F.asc("pr_id")])
    return csvout.read_csv(spark, path)


add("s6_csv_sink", _csv_sink, "SELECT COLUMNS(*)::VARCHAR FROM v10")

AD_HOC = """SELECT d.ym, d.pr_id, m.total_cnt, count(*) AS days, max(d.total_cnt) AS top_day
FROM {daily} d JOIN {monthly} m ON d.ym = m.ym AND d.pr_id = m.pr_id GROUP BY d.ym, d.pr_id, m.total_cnt"""
add("s7_ad_hoc_sql", on(lambda ws: ws.sql(AD_HOC.format(daily="rt_cnt_daily", monthly="rt_cnt_monthly"))),
    AD_HOC.format(daily="v5", monthly="v8"))
add("s8_preview", on(lambda ws: csvout.preview(ws.get("monthly_transaction_stats"), 20, ["ym", "pr_id"])),
    """SELECT *, (SELECT count(*) FROM v10) AS total_rows, (SELECT count(*) FROM v10) > 20 AS truncated
       FROM v10 ORDER BY ym, pr_id LIMIT 20""")

# ---------------------------------------------------------------- landing


def raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(proxies.raw_sheet(proxies.table(spark, sf_dir, "orders")))


def _per_file(df: DataFrame) -> DataFrame:
    return df.groupBy("_file", "_dt").agg(F.count(F.lit(1)).alias("row_count"))


PER_FILE = """SELECT _file, regexp_extract(_file, '(\\d{8})', 1) AS _dt, count(*) AS row_count
FROM raw_sheet WHERE _file LIKE 'daily-%' """
add("i1_select_files", raw(lambda df: _per_file(landing.select_files(df))), PER_FILE + "GROUP BY ALL")
add("i2_single_date", raw(lambda df: _per_file(landing.select_files(df, date="19980501"))),
    PER_FILE + "AND _file LIKE '%19980501%' GROUP BY ALL")
add("i3_newest_files", raw(lambda df: _per_file(landing.select_files(df, newest=3))),
    PER_FILE + "GROUP BY ALL ORDER BY _file DESC LIMIT 3")


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    def tagged(name: str, sheet: str, key: str) -> DataFrame:
        return proxies.table(spark, sf_dir, name).select(F.lit(sheet).alias("_sheet"), C(key).alias("key"))

    rows = (tagged("orders", "RT_CNT", "o_orderkey").unionAll(tagged("events", "MON_LOG", "event_id"))
            .unionAll(tagged("customer", "SCRATCH", "c_custkey")))
    return landing.route(rows).groupBy("_sheet").agg(F.count(F.lit(1)).alias("row_count"),
                                                     F.max("key").alias("last_key"))


add("i4_route_sheets", _routed, """
SELECT 'RT_CNT' AS _sheet, count(*) AS row_count, max(o_orderkey) AS last_key FROM orders
UNION ALL SELECT 'MON_LOG', count(*), max(event_id) FROM events""")


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = proxies.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return landing.with_clean_headers(rows, [" KEY ", "", "  "])


add("i5_clean_headers", _headers,
    "SELECT o_orderkey AS \"KEY\", o_orderpriority AS column_1, o_orderstatus AS column_2 FROM orders")
add("i6_drop_blank_rows", raw(landing.drop_blank_rows), "SELECT * FROM raw_sheet WHERE \"PR_ID\" IS NOT NULL")
add("i7_normal_values", raw(lambda df: landing.normalise(landing.drop_blank_rows(landing.select_files(df)))),
    "SELECT * FROM landed_sheet")
add("i8_lineage", raw(lambda df: landing.prepare(landing.select_files(df), "RT_CNT", 1700000000)),
    "SELECT *, 'RT_CNT' AS _sheet, CAST(1700000000 AS BIGINT) AS _ingest_ts FROM landed_sheet")

RAW_CELLS = T.StructType([
    T.StructField("CALDY", T.StringType()), T.StructField("PR_ID", T.StringType()),
    T.StructField("ORDER_NO", T.DoubleType()), T.StructField("AMOUNT", T.DoubleType()),
    T.StructField("FIRST", T.TimestampNTZType())])
RAW_EVENTS = T.StructType([T.StructField("MONITOR_KIND", T.StringType()), T.StructField("EVENT_NO", T.LongType())])
RAW_SHEETS = {"RT_CNT": RAW_CELLS, "MON_LOG": RAW_EVENTS}


def _inbox(spark: SparkSession, sf_dir: str) -> str:
    """Two sheets of decoded workbooks; the second is missing in most workbooks."""
    inbox = scratch_dir(spark, "inbox")
    cells = proxies.raw_sheet(proxies.table(spark, sf_dir, "orders"))
    cells.repartition("_file").write.partitionBy("_file").json(f"{inbox}/_sheet=RT_CNT")
    log = proxies.table(spark, sf_dir, "events").select(
        C("event_type").alias("MONITOR_KIND"), C("event_id").alias("EVENT_NO"),
        F.when(C("event_id") % 2 == 0, F.lit("daily-19980501.xlsx"))
         .otherwise(F.lit("daily-19980601.xlsx")).alias("_file"))
    log.write.partitionBy("_file").json(f"{inbox}/_sheet=MON_LOG")
    return inbox


def _land(spark: SparkSession, inbox: str, **options) -> DataFrame:
    return landing.land(spark, inbox, f"{inbox}-lake", RAW_SHEETS, **options)


def _landed_schema(sheet: str) -> T.StructType:
    """Cells without a declared type land as text."""
    return T.StructType([*[T.StructField(f.name, T.StringType()) for f in RAW_SHEETS[sheet]], *SHEET_LINEAGE])


def _landed(spark: SparkSession, inbox: str, sheet: str = "RT_CNT") -> DataFrame:
    source = spark.read.schema(_landed_schema(sheet)).option("basePath", f"{inbox}-lake")
    return source.parquet(f"{inbox}-lake/_sheet={sheet}")


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land one day, then everything: the second run skips the file that is complete."""
    inbox = _inbox(spark, sf_dir)
    _land(spark, inbox, date="19980601", ingest_ts=1)
    return _land(spark, inbox, ingest_ts=2)


add("i9_incremental", _incremental, """
SELECT _file, CAST(CASE _file WHEN 'daily-19980601.xlsx' THEN 0 WHEN 'daily-19980501.xlsx' THEN 2 ELSE 1 END AS BIGINT) AS outputs,
       _file <> 'daily-19980601.xlsx' AS processed
FROM (SELECT DISTINCT _file FROM raw_sheet WHERE _file LIKE 'daily-%')""")


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land what is available, twice: the checkpoint keeps the second run from landing again."""
    inbox = _inbox(spark, sf_dir)
    for _ in range(2):
        land_available(spark, inbox, f"{inbox}-stream", "RT_CNT", RAW_CELLS, f"{inbox}-checkpoint")
    source = spark.read.schema(_landed_schema("RT_CNT")).option("basePath", f"{inbox}-stream")
    return source.parquet(f"{inbox}-stream/_sheet=RT_CNT").drop("_ingest_ts")


add("i9_available_now_stream", _streamed, "SELECT *, 'RT_CNT' AS _sheet FROM landed_sheet")


def _forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land everything, then force one day: only that day is rewritten."""
    inbox = _inbox(spark, sf_dir)
    _land(spark, inbox, ingest_ts=1)
    _land(spark, inbox, date="19980501", force=True, ingest_ts=2)
    return _landed(spark, inbox)


add("i10_force", _forced, """
SELECT *, 'RT_CNT' AS _sheet, CAST(CASE _dt WHEN '19980501' THEN 2 ELSE 1 END AS BIGINT) AS _ingest_ts
FROM landed_sheet""")


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    inbox = _inbox(spark, sf_dir)
    _land(spark, inbox, ingest_ts=1)
    both = [_landed(spark, inbox, sheet).select("_sheet", "_dt", "_file") for sheet in RAW_SHEETS]
    return landing.landing_summary(both[0].unionAll(both[1]))


add("i11_landing_summary", _summary, """
SELECT 'RT_CNT' AS _sheet, _dt, count(*) AS row_count, count(DISTINCT _file) AS file_count FROM landed_sheet GROUP BY ALL
UNION ALL
SELECT 'MON_LOG', CASE WHEN event_id % 2 = 0 THEN '19980501' ELSE '19980601' END, count(*), CAST(1 AS BIGINT)
FROM events GROUP BY ALL""")



def _undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet without declared columns: one column is a number in some workbooks and text in others, one is missing in some."""
    inbox, day, key = scratch_dir(spark, "undeclared"), C("o_orderdate").cast("date"), C("o_orderkey")
    even = F.month(day) % 2 == 0
    common = [key.alias("KEY"), C("o_totalprice").alias(" PRICE "), day.cast("string").alias("DAY")]
    plain = F.to_json(F.struct(*common, key.alias("N")))
    late = F.date_format(day, "yyyy-MM-dd'T'08:00:00")
    lines = proxies.table(spark, sf_dir, "orders").select(
        F.when(even, plain).otherwise(F.to_json(F.struct(*common, F.concat(F.lit("n"), key.cast("string")).alias("N"), late.alias("LATE")))).alias("value"),
        F.concat(F.lit("daily-"), F.date_format(F.trunc(day, "month"), "yyyyMMdd"), F.lit(".xlsx")).alias("_file"))
    lines.repartition("_file").write.partitionBy("_file").text(f"{inbox}/_sheet=BT_CNT")
    landing.land(spark, inbox, f"{inbox}-lake", ingest_ts=7)
    return Workspace.open(spark, f"{inbox}-lake").get("bt_cnt")


add("s1_undeclared_columns", _undeclared, """
SELECT o_orderkey AS "KEY", CASE WHEN month(o_orderdate) % 2 = 0 THEN '' ELSE 'n' END || o_orderkey AS "N",
       CAST(o_totalprice AS DOUBLE) AS "PRICE", CAST(o_orderdate AS DATE) AS "DAY",
       CASE WHEN month(o_orderdate) % 2 = 1 THEN date_trunc('day', o_orderdate) + INTERVAL 8 HOUR END AS "LATE",
       'daily-' || strftime(o_orderdate, '%Y%m') || '01.xlsx' AS _file, 'BT_CNT' AS _sheet,
       strftime(o_orderdate, '%Y%m') || '01' AS _dt, CAST(7 AS BIGINT) AS _ingest_ts
FROM orders""")


def _inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with columns beyond the declared ones, read by glob with inferred types."""
    path = scratch_dir(spark, "inferred")
    rows = proxies.workspace(spark, sf_dir).get("rt_cnt")
    extra = [(C("total_cnt") * 2).alias("TWICE"), F.when(C("ok_cnt") % 2 == 0, C("pr_id")).alias("NOTE")]
    with_headers(rows, SHEET_COLUMNS["RT_CNT"], [*LINEAGE, *extra]).write.json(path, compression="gzip")
    return lake.read_flat_sheet(spark, f"{path}/*.json.gz", "RT_CNT", inferred=True)


add("s1_inferred_columns", _inferred,
    """SELECT *, total_cnt * 2 AS "TWICE", CASE WHEN ok_cnt % 2 = 0 THEN pr_id END AS "NOTE" FROM rt_cnt""")


# ---------------------------------------------------------------- kept datasets


def _kept(spark: SparkSession, rows: DataFrame, sheet: str, followers: tuple = ()) -> Store:
    """A sheet landed in two runs, the landed days of the second restating days of the first; the kept tables follow both."""
    path = scratch_dir(spark, "kept")
    store = Store(spark, f"{path}/lake", f"{path}/store", prefixes=proxies.PREFIXES, excluded_codes=proxies.EXCLUDED)
    for run in (1, 2):
        own = with_headers(rows.filter((C("_dt").cast("int") % 10 < 5) == F.lit(run == 1)), SHEET_COLUMNS[sheet], LINEAGE)
        days = own.groupBy("_sheet", "_dt").agg(F.count("*").alias("row_count"), F.min("_file").alias("_file"))
        lake.write_days(own.hint("rebalance", C("_dt")), store.lake)
        landing.record_days(days.withColumn("_run", F.lit(run).cast("long")), store.lake)
        store.refresh(followers=followers)
    return store


add("w3_incremental_log", lambda spark, sf_dir: _kept(spark, proxies.workspace(spark, sf_dir).get("mon_log"), "MON_LOG").get("monitor_log"),
    "SELECT * FROM v11")


def _followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month rollup of daily event counts; every third day is restated a day later, by a workbook of another run."""
    day = C("ts").cast("date")
    counts = proxies.table(spark, sf_dir, "events").groupBy(day.alias("day"), C("event_type").alias("pr_id")).agg(F.count("*").alias("n"))
    versions = F.when(F.dayofmonth("day") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = counts.withColumn("v", F.explode(versions)).withColumn("_dt", F.date_format(F.date_add("day", C("v") + 1), "yyyyMMdd"))
    none, n = F.lit(None).cast("string"), C("n") + C("v")
    rows = rows.select(calendar.month_day_text(C("day")).alias("caldy"), "pr_id", n.alias("total_cnt"), n.alias("ok_cnt"),
                       *[F.lit(0).cast("long").alias(c) for c in ("fail_cnt", "rev_ok_cnt", "timeout_cnt", "other_err_cnt")],
                       none.alias("first_tx_raw"), none.alias("last_tx_raw"), F.concat(F.lit("F"), "_dt").alias("_file"),
                       F.lit("RT_CNT").alias("_sheet"), "_dt", F.lit(0).cast("long").alias("_ingest_ts"))
    kept = _kept(spark, rows, "RT_CNT", ("rt_cnt_monthly", "rt_cnt_weekly"))
    months = kept.get("rt_cnt_monthly").select(C("ym").alias("period"), "pr_id", "data_days", "total_cnt", "peak_day_cnt", "peak_day")
    weeks = kept.get("rt_cnt_weekly").select(C("week_start").cast("string").alias("period"), "pr_id", "data_days", "total_cnt", "peak_day_cnt", "peak_day")
    return months.unionAll(weeks.groupBy("period", "pr_id").agg(F.sum("data_days").alias("data_days"), F.sum("total_cnt").alias("total_cnt"),
                                                               F.max("peak_day_cnt").alias("peak_day_cnt"), F.max_by("peak_day", F.struct("peak_day_cnt", earlier(C("peak_day")))).alias("peak_day")))


add("v8_rollups_after_restatement", _followed, """
SELECT period, pr_id, count(*) AS data_days, CAST(sum(n) AS BIGINT) AS total_cnt, max(n) AS peak_day_cnt, min(d) FILTER (WHERE n = top) AS peak_day
FROM (SELECT *, max(n) OVER (PARTITION BY period, pr_id) AS top FROM (
  SELECT unnest([strftime(d, '%Y-%m'), strftime(date_trunc('week', d), '%Y-%m-%d')]) AS period, d, pr_id, n
  FROM (SELECT CAST(ts AS DATE) AS d, event_type AS pr_id, count(*) + CASE WHEN day(CAST(ts AS DATE)) % 3 = 0 THEN 1 ELSE 0 END AS n
        FROM events GROUP BY 1, 2)))
GROUP BY period, pr_id""")

# ---------------------------------------------------------------- projections



def order_day():
    return C("o_orderdate").cast("date")



add("p1_rename", on(lambda ws: lake.english(with_headers(ws.get("rt_cnt"), SHEET_COLUMNS["RT_CNT"]),
                                            SHEET_COLUMNS["RT_CNT"])),
    "SELECT * EXCLUDE (_file, _sheet, _dt, _ingest_ts) FROM rt_cnt")
add("p2_star_and_derived", on(lambda ws: monitor.server_samples(ws.get("monitor_log"))),
    f"""SELECT *, total_disk - free_disk AS used_disk, total_mem - free_mem AS used_mem,
        CAST(log_createtime AS DATE) AS log_date, {oracle.HOUR} FROM v11 WHERE monitor_kind = 'SERVER'""")
add("p3_trim", on(lambda ws: clean.rt_pr_hh24_clean(ws.get("rt_pr_hh24"), all_versions=True).select("pr_id", "caltm", "_dt")),
    "SELECT trim(pr_id) AS pr_id, caltm, _dt FROM rt_pr_hh24")
add("p4_file_date", on(lambda ws: ws.get("rt_cnt").select("caldy", "pr_id", "_dt",
                                                          calendar.file_date(C("_dt")).alias("file_dt"))),
    "SELECT caldy, pr_id, _dt, CAST(strptime(_dt, '%Y%m%d') AS DATE) AS file_dt FROM rt_cnt")
add("p5_iso_stamp", source("orders", lambda: ["o_orderkey", calendar.iso_stamp(
        F.concat(order_day().cast("string"), F.when(C("o_orderkey") % 5 == 0, F.lit(""))
                 .when(C("o_orderkey") % 5 == 1, F.lit("T08:00:00"))
                 .when(C("o_orderkey") % 5 == 2, F.lit("T08:00:00.5"))
                 .when(C("o_orderkey") % 5 == 3, F.lit("T25:00:00.000000"))
                 .otherwise(F.lit("T20:15:30.123456")))).alias("stamp")]),
    """SELECT o_orderkey, try_strptime(strftime(o_orderdate, '%Y-%m-%d') || (CASE o_orderkey % 5 WHEN 0 THEN ''
       WHEN 1 THEN 'T08:00:00' WHEN 2 THEN 'T08:00:00.5' WHEN 3 THEN 'T25:00:00.000000'
       ELSE 'T20:15:30.123456' END), '%Y-%m-%dT%H:%M:%S.%f') AS stamp FROM orders""")


def key_text():
    return F.when(C("o_orderkey") % 11 == 0, F.lit("AB1")).otherwise(calendar.month_day_text(order_day()))


KEY_SQL = "CASE WHEN o_orderkey % 11 = 0 THEN 'AB1' ELSE strftime(o_orderdate, '%m%d') END"
add("p6_key_parts", source("orders", lambda: ["o_orderkey", calendar.key_part(key_text(), 1).alias("month"),
                           calendar.key_part(key_text(), 3).alias("day")]),
    f"SELECT o_orderkey, TRY_CAST(left(k, 2) AS INT) AS month, TRY_CAST(k[3:4] AS INT) AS day FROM (SELECT o_orderkey, {KEY_SQL} AS k FROM orders)")


def parts():
    return [F.year("o_orderdate"), (C("o_orderkey") % 14).cast("int"), (C("o_custkey") % 33).cast("int")]


add("p7_date_from_parts", source("orders", lambda: ["o_orderkey", calendar.date_from_parts(*parts()).alias("day")]),
    """SELECT o_orderkey, TRY_CAST(year(o_orderdate) || '-' || lpad(CAST(o_orderkey % 14 AS VARCHAR), 2, '0') || '-'
       || lpad(CAST(o_custkey % 33 AS VARCHAR), 2, '0') AS DATE) AS day FROM orders""")
add("p8_year_repair", source("orders", lambda: ["o_orderkey", calendar.latest_not_after(
        order_day(), F.add_months(order_day(), (C("o_orderkey") % 5 - 2).cast("int"))).alias("day")]),
    """SELECT o_orderkey, CASE WHEN d > f THEN CAST(d - INTERVAL 1 YEAR AS DATE) ELSE d END AS day
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
                    CAST(o_orderdate + to_months(CAST(o_orderkey % 5 - 2 AS INT)) AS DATE) AS f FROM orders)""")
add("p9_preferred_date", over("rt_cnt_clean", "pr_id", "caldy", "_dt", "first_tx_raw", "tx_dt"),
    "SELECT pr_id, caldy, _dt, first_tx_raw, tx_dt FROM v1")
add("p10_date_parts", over("rt_cnt_clean", lambda: ["pr_id", "tx_dt", "tx_year", "tx_month", "tx_day",
                           calendar.hour_of(C("tx_ts_last")).alias("last_hour")]),
    "SELECT pr_id, tx_dt, tx_year, tx_month, tx_day, CAST(hour(tx_ts_last) AS INT) AS last_hour FROM v1")
add("p11_date_text", source("orders", lambda: ["o_orderkey", calendar.day_text(order_day()).alias("day"),
                            calendar.month_text(order_day()).alias("month"), calendar.year_text(order_day()).alias("year"),
                            calendar.month_day_text(order_day()).alias("key")]),
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m') AS month,
       strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m%d') AS key FROM orders""")
add("p12_key_matches", over("rt_node_hh24_clean", "pr_id", "node_id", "caltm", "tx_dt", "caltm_match_txdt"),
    "SELECT pr_id, node_id, caltm, tx_dt, caltm_match_txdt FROM v4")
add("p13_milliseconds", over("rt_tmspt_clean", "pr_id", "tx_dt", "avg_tm_sec", "avg_tm_ms"),
    "SELECT pr_id, tx_dt, avg_tm_sec, avg_tm_ms FROM v2")
add("p14_hour_stamp", over("rt_pr_hh24_clean", "pr_id", "tx_dt", "tx_hour", "tx_hour_ts", "tx_hour_ts_str"),
    "SELECT pr_id, tx_dt, tx_hour, tx_hour_ts, tx_hour_ts_str FROM v3")


def code_text():
    return F.concat(F.element_at(F.array(F.lit("G"), F.lit("P"), F.lit("AB")), (C("p_partkey") % 3 + 1).cast("int")),
                     (C("p_partkey") % 20000).cast("string"))


add("p15_padded_code", source("part", lambda: ["p_partkey", text.padded_code(code_text()).alias("code")]),
    """SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN 'AB' || CAST(p_partkey % 20000 AS VARCHAR)
       ELSE CASE p_partkey % 3 WHEN 0 THEN 'G' ELSE 'P' END || CASE WHEN p_partkey % 20000 < 10000
            THEN lpad(CAST(p_partkey % 20000 AS VARCHAR), 4, '0') ELSE CAST(p_partkey % 20000 AS VARCHAR) END
       END AS code FROM part""")
add("p15_code_as_read", over("rt_tmspt_clean", "pr_id", "pr_id_norm", "tx_dt"), "SELECT pr_id, pr_id_norm, tx_dt FROM v2")
add("p16_prefix_removal", on(lambda ws: ws.get("mon_log").select(
        "_file", text.without_prefixes(C("mon_content"), ws.prefixes).alias("body"))),
    f"SELECT _file, {oracle.PREFIX_REMOVAL} AS body FROM mon_log")


def odd_stamp():
    return F.when(C("event_id") % 3 == 0, C("ts").cast("string")).when(
    C("event_id") % 3 == 1, F.replace(F.substring(C("ts").cast("string"), 1, 10), F.lit("-"), F.lit("/"))
).otherwise(F.lit("not a time"))


add("p17_loose_stamp", source("events", lambda: ["event_id", calendar.loose_stamp(odd_stamp()).alias("stamp")]),
    """SELECT event_id, TRY_CAST(CASE event_id % 3 WHEN 0 THEN CAST(ts AS VARCHAR) WHEN 1 THEN strftime(ts, '%Y/%m/%d')
       ELSE 'not a time' END AS TIMESTAMP) AS stamp FROM events""")
add("p18_metric_text", on(lambda ws: ws.get("mon_log").select(
        "_file", text.metric(C("mon_content"), "usedMemRate").alias("mem"),
        text.metric(C("mon_content"), "freeDisk").alias("disk"))),
    """SELECT _file, regexp_extract(mon_content, 'usedMemRate:([^,]+)', 1) AS mem,
       regexp_extract(mon_content, 'freeDisk:([^,]+)', 1) AS disk FROM mon_log""")
add("p19_sentinel", on(lambda ws: ws.get("mon_log").select(
        "_file", text.rate(C("mon_content"), "usedCPURate").alias("cpu"))),
    """SELECT _file, TRY_CAST(replace(nullif(regexp_extract(mon_content, 'usedCPURate:([^,]+)', 1), 'N/A%'), '%', '')
       AS DECIMAL(5, 2)) AS cpu FROM mon_log""")


def odd_number():
    return F.concat((C("event_id") % 1200).cast("string"), F.element_at(
    F.array(F.lit(""), F.lit(".235"), F.lit("GB"), F.lit(".5")), (C("event_id") % 4 + 1).cast("int")))


add("p20_tolerant_decimal", source("events", lambda: [
        "event_id", text.rate(F.concat(F.lit("a:1,b:"), odd_number(), F.lit("%,c:2")), "b").alias("rate"),
        text.size(F.concat(F.lit("a:1,b:"), odd_number()), "b").alias("size")]),
    """SELECT event_id, TRY_CAST(x AS DECIMAL(5, 2)) AS rate, TRY_CAST(x AS DECIMAL(10, 2)) AS size
       FROM (SELECT event_id, CAST(event_id % 1200 AS VARCHAR) || CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '.235'
             WHEN 2 THEN 'GB' ELSE '.5' END AS x FROM events)""")
add("p21_connection_status", over("monitor_log", "monitor_kind", "source_file", "db_conn_status"),
    "SELECT monitor_kind, source_file, db_conn_status FROM v11")
add("p22_used_sizes", on(lambda ws: monitor.server_samples(ws.get("monitor_log")).select(
        "source_file", "used_mem", "used_disk")),
    "SELECT source_file, total_mem - free_mem AS used_mem, total_disk - free_disk AS used_disk FROM v11 WHERE monitor_kind = 'SERVER'")
add("p23_weekday", over("rt_cnt_daily", "tx_date", "pr_id", "weekday"), "SELECT tx_date, pr_id, weekday FROM v5")
add("p24_iso_week", source("orders", lambda: ["o_orderkey", calendar.iso_week_label(order_day()).alias("iso_yw")]),
    "SELECT o_orderkey, strftime(o_orderdate, '%G-%V') AS iso_yw FROM orders")
add("p25_week_bounds", over("rt_cnt_weekly", "year", "iso_yw", "pr_id", "week_start", "week_end"),
    """SELECT year, iso_yw, pr_id, CAST(strptime(iso_yw || '-1', '%G-%V-%u') AS DATE) AS week_start,
       CAST(strptime(iso_yw || '-7', '%G-%V-%u') AS DATE) AS week_end FROM v7""")
add("p26_month_bounds", source("orders", lambda: ["o_orderkey", calendar.month_start(order_day()).alias("first"),
                               calendar.month_end(order_day()).alias("last"), calendar.days_in_month(order_day()).alias("days")]),
    """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS first, last_day(o_orderdate) AS last,
       CAST(day(last_day(o_orderdate)) AS INT) AS days FROM orders""")
add("p27_percentage", source("lineitem", lambda: ["l_orderkey", "l_linenumber", numbers.percentage(
        C("l_linenumber"), C("l_quantity").cast("bigint") % 7).alias("pct")]),
    """SELECT l_orderkey, l_linenumber, round(l_linenumber * 100.0 / nullif(CAST(l_quantity AS BIGINT) % 7, 0), 2) AS pct
       FROM lineitem""")
add("p28_round_and_narrow", source("orders", lambda: ["o_orderkey", numbers.whole_number(C("o_totalprice")).alias("price"),
                                   numbers.whole_number(C("o_totalprice") / 7, "int").alias("seventh")]),
    "SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) AS price, CAST(round(o_totalprice / 7) AS INT) AS seventh FROM orders")
add("p29_republic_date", source("orders", lambda: ["o_orderkey", calendar.republic_date(order_day()).alias("day")]),
    f"SELECT o_orderkey, {oracle.republic('o_orderdate')} AS day FROM orders")
add("p30_hour_range", over("rt_pr_hh24_clean", lambda: ["pr_id", "tx_hour_ts",
                           calendar.hour_range(C("tx_dt"), C("tx_hour")).alias("label")]),
    f"""SELECT pr_id, tx_hour_ts, {oracle.republic('tx_dt')} || strftime(tx_hour_ts, ' %H:00~%H:59') AS label FROM v3""")
add("p31_two_line_label", over("rt_tmspt_clean", lambda: ["pr_id", "tx_dt", text.lines(
        calendar.republic_date(C("tx_dt")), numbers.whole_number(C("avg_tm_ms"), "int")).alias("label")]),
    f"SELECT pr_id, tx_dt, {oracle.republic('tx_dt')} || chr(10) || CAST(CAST(round(avg_tm_ms) AS INT) AS VARCHAR) AS label FROM v2")
add("p32_share_label", over("monthly_transaction_stats", "ym", "pr_id", "share"), "SELECT ym, pr_id, share FROM v10")
add("p33_default_name", over("monthly_transaction_stats", "ym", "pr_id", "name"), "SELECT ym, pr_id, name FROM v10")
add("p34_text_to_date", over("rt_cnt_daily", lambda: ["pr_id", C("tx_date").cast("date").alias("day")]),
    "SELECT pr_id, CAST(tx_date AS DATE) AS day FROM v5")

# ---------------------------------------------------------------- filters

add("f1_present_host", on(lambda ws: clean.log_rows(ws.get("mon_log").withColumn(
        "target_ip", F.when(C("target_ip") != "10.0.0.3", C("target_ip")).otherwise(F.lit("")))).select("_file", "target_ip")),
    "SELECT _file, target_ip FROM mon_log WHERE target_ip <> '10.0.0.3' AND monitor_kind IS NOT NULL")
add("f2_server_rows", on(lambda ws: monitor.server_samples(ws.get("monitor_log")).select("source_file", "target_ip")),
    "SELECT source_file, target_ip FROM v11 WHERE monitor_kind = 'SERVER'")
add("f3_jvm_rows", on(lambda ws: monitor.jvm_samples(ws.get("monitor_log")).select("source_file", "used_heap_mem")),
    "SELECT source_file, used_heap_mem FROM v11 WHERE monitor_kind = 'JVM' AND used_heap_mem IS NOT NULL")


def _with_bad_keys(ws: Workspace) -> DataFrame:
    sheet = ws.get("rt_tmspt").withColumn(
        "caldy", F.when(F.substring("caldy", 3, 2) == "07", F.lit("AB12")).otherwise(C("caldy")))
    return clean.rt_tmspt_clean(sheet).select("pr_id", "tx_dt", "avg_tm_sec")


add("f4_drop_undated", on(_with_bad_keys), "SELECT pr_id, tx_dt, avg_tm_sec FROM v2 WHERE day(tx_dt) <> 7")
add("f5_excluded_code", on(lambda ws: rollups.without_codes(ws.get("rt_cnt_clean"), ws.excluded_codes)
                           .select("pr_id", "tx_dt", "total_cnt")),
    f"SELECT pr_id, tx_dt, total_cnt FROM v1 WHERE pr_id NOT IN ('{proxies.EXCLUDED[0]}')")
add("f6_trailing_window", on(lambda ws: trailing_days(ws.get("rt_cnt_clean").select("pr_id", "tx_dt", "total_cnt"),
                                                      "tx_dt", 10)),
    "SELECT pr_id, tx_dt, total_cnt FROM v1 WHERE tx_dt >= (SELECT max(tx_dt) FROM v1) - INTERVAL 10 DAY")

# ---------------------------------------------------------------- joins

add("j1_counts_and_times", over("rt_cnt_daily_with_tmspt", "tx_date", "pr_id", "total_cnt", "avg_tm_ms"),
    "SELECT tx_date, pr_id, total_cnt, avg_tm_ms FROM v6")
add("j2_host_application", over("monitor_daily", "application", "target_ip", "log_date", "record_count"),
    "SELECT application, target_ip, log_date, record_count FROM v12")


def _zero_ports(ws: Workspace) -> Workspace:
    """Every other sample writes its port with a leading zero."""
    log = ws.get("mon_log").withColumn("target_port", F.when(
        C("_file").cast("bigint") % 2 == 0, F.concat(F.lit("0"), "target_port")).otherwise(C("target_port")))
    return Workspace(ws.spark, {**ws.frames, "mon_log": log}, prefixes=ws.prefixes)


ZERO_LOG = """(SELECT * REPLACE (CASE WHEN CAST(source_file AS BIGINT) % 2 = 0 THEN '0' ELSE '' END || target_port AS target_port)
FROM zero_log)"""
oracle.VIEWS["zero_log"] = oracle.VIEWS["v11"].replace(
    "DISTINCT ON (monitor_kind, target_ip, target_port, log_createtime)",
    "DISTINCT ON (monitor_kind, target_ip, target_port, log_createtime, e % 2)").replace(
    "ORDER BY monitor_kind, target_ip, target_port, log_createtime,",
    "ORDER BY monitor_kind, target_ip, target_port, log_createtime, e % 2,").replace(
    "SELECT *, replace(", "SELECT *, CAST(_file AS BIGINT) AS e, replace(")
PORT_JOIN = """SELECT application, target_ip, target_port, {day} AS log_date{hour}, count(*) AS record_count
FROM {log} LEFT JOIN (SELECT DISTINCT application, ipaddr, port FROM v18) a ON target_ip = ipaddr AND {on}
WHERE monitor_kind = 'JVM' AND used_heap_mem IS NOT NULL GROUP BY ALL"""
JVM_COLUMNS = ["application", "target_ip", "target_port", "log_date"]
add("j3_numeric_port", on(lambda ws: _zero_ports(ws).get("monitor_daily_jvm").select(*JVM_COLUMNS, "record_count")),
    PORT_JOIN.format(day="CAST(CAST(log_createtime AS DATE) AS TIMESTAMP)", hour="", log=ZERO_LOG,
                     on="CAST(target_port AS BIGINT) = port"))
add("j4_text_port", on(lambda ws: _zero_ports(ws).get("monitor_hourly_jvm").select(
        *JVM_COLUMNS, "log_hour", "record_count")),
    PORT_JOIN.format(day="CAST(log_createtime AS DATE)", hour=f", {oracle.HOUR}", log=ZERO_LOG,
                     on="target_port = CAST(port AS VARCHAR)"))


def _code_rows(ws: Workspace) -> DataFrame:
    """Month totals per registered code, one code listed twice."""
    codes = ws.get("pr_info")
    codes = codes.unionAll(codes.filter(C("pr_id") == "2-HIGH"))
    hours = ws.get("rt_pr_hh24_clean").filter(C("tx_dt").isNotNull())
    frame = stats.code_frame(stats.monthly(stats.day_frame(hours)), ["ym"])
    return stats.with_codes(frame, codes).select("ym", "pr_id", "category", "total_cnt", "active_days")


add("j5_code_dimension", on(_code_rows), """
SELECT c.ym, c.pr_id, c.category, c.total_cnt, c.active_days
FROM (SELECT ym, d.pr_id, category, CAST(sum(n) AS BIGINT) AS total_cnt, count(*) AS active_days
      FROM (SELECT ym, pr_id, tx_dt, sum(tx_cnt) AS n FROM month_hours GROUP BY ALL) d
      JOIN (FROM v16 UNION ALL FROM v16 WHERE pr_id = '2-HIGH') i ON d.pr_id = i.pr_id GROUP BY ALL) c
JOIN (FROM v16 UNION ALL FROM v16 WHERE pr_id = '2-HIGH') i ON c.pr_id = i.pr_id""")
add("j6_peaks_joined", over("monthly_transaction_stats", "ym", "pr_id", "peak_day", "peak_day_cnt",
                            "peak_hour_range", "peak_hour_cnt"),
    "SELECT ym, pr_id, peak_day, peak_day_cnt, peak_hour_range, peak_hour_cnt FROM v10")


def _shares(ws: Workspace) -> DataFrame:
    hours = ws.get("rt_pr_hh24_clean").filter(C("tx_dt").isNotNull())
    frame = stats.code_frame(stats.monthly(stats.day_frame(hours)), ["ym"])
    return stats.with_period_total(frame, ["ym"]).select("ym", "pr_id", "total_cnt", "all_cnt")


def _written_shares(ws: Workspace) -> DataFrame:
    """Codes and totals from one pass, some rows without a code, joined from the written table."""
    hours = ws.get("rt_pr_hh24_clean").filter(C("tx_dt").isNotNull()).withColumn("pr_id", F.nullif("pr_id", F.lit("2-HIGH")))
    frame, path = stats.code_totals(stats.monthly(stats.day_frame(hours)), ["ym"]), scratch_dir(ws.spark, "totals")
    frame.write.parquet(path)
    written = ws.spark.read.schema(frame.schema).parquet(path)
    return stats.with_period_total(written, ["ym"]).select("ym", "pr_id", "total_cnt", "all_cnt", "active_days")


add("j7_totals_by_grouping_sets", on(_written_shares), """
SELECT ym, c AS pr_id, CAST(sum(tx_cnt) AS BIGINT) AS total_cnt, any_value(all_cnt) AS all_cnt, count(DISTINCT tx_dt) AS active_days
FROM (SELECT *, nullif(pr_id, '2-HIGH') AS c FROM month_hours)
JOIN (SELECT ym, CAST(sum(tx_cnt) AS BIGINT) AS all_cnt FROM month_hours GROUP BY ym) USING (ym) GROUP BY ym, c""")
add("j7_month_total", on(_shares), """
SELECT ym, pr_id, CAST(sum(tx_cnt) AS BIGINT) AS total_cnt, any_value(all_cnt) AS all_cnt
FROM month_hours JOIN (SELECT ym, CAST(sum(tx_cnt) AS BIGINT) AS all_cnt FROM month_hours GROUP BY ym) USING (ym) GROUP BY ALL""")
add("j8_scalar_maximum", on(lambda ws: trailing_days(ws.get("monitor_hourly").select(
        "target_ip", "application", "log_date", "log_hour"), "log_date", 0)),
    "SELECT target_ip, application, log_date, log_hour FROM v13 WHERE log_date = (SELECT max(log_date) FROM v13)")

# ---------------------------------------------------------------- aggregations

add("a1_day_counts", over("rt_cnt_daily", "tx_date", "pr_id", "total_cnt", "ok_cnt", "fail_cnt", "timeout_cnt", "ok_rate"),
    "SELECT tx_date, pr_id, total_cnt, ok_cnt, fail_cnt, timeout_cnt, ok_rate FROM v5")
add("a2_mean_times", on(lambda ws: rollups.mean_times(ws.get("rt_tmspt_clean"))),
    "SELECT tx_dt, pr_id, avg(avg_tm_sec) AS avg_tm_sec, avg(avg_tm_ms) AS avg_tm_ms FROM v2 GROUP BY ALL")
add("a3_week_rollup", over("rt_cnt_weekly", "year", "iso_yw", "pr_id", "data_days", "total_cnt",
                           "avg_per_data_day", "avg_per_7_days"),
    "SELECT year, iso_yw, pr_id, data_days, total_cnt, avg_per_data_day, avg_per_7_days FROM v7")
add("a4_month_rollup", over("rt_cnt_monthly", "ym", "pr_id", "total_cnt", "avg_per_month_day"),
    "SELECT ym, pr_id, total_cnt, avg_per_month_day FROM v8")
add("a5_month_without_code", over("rt_cnt_monthly_without", "ym", "total_cnt", "peak_day", "peak_day_cnt"),
    "SELECT ym, total_cnt, peak_day, peak_day_cnt FROM v9")
add("a6_distinct_days", over("rt_cnt_monthly_without", "ym", "data_days"), "SELECT ym, data_days FROM v9")
add("a7_peak_value_date", on(lambda ws: rollups.day_counts(ws.get("rt_cnt_clean")).groupBy("pr_id").agg(
        peak_present(C("tx_dt"), C("fail_cnt"), C("fail_cnt"), earlier(C("tx_dt"))).alias("worst_day"))),
    "SELECT pr_id, first(tx_dt ORDER BY fail_cnt DESC, tx_dt) AS worst_day FROM days GROUP BY ALL")
DAY_STATS = """SELECT tx_dt, pr_id, CAST(sum(tx_cnt) AS BIGINT) AS day_cnt,
round(sum(avg_tm_ms * tx_cnt) / nullif(sum(tx_cnt), 0), 3) AS day_ms FROM month_hours GROUP BY ALL"""


def _day_stats(ws: Workspace) -> DataFrame:
    hours = ws.get("rt_pr_hh24_clean").filter(C("tx_dt").isNotNull())
    return stats.day_frame(hours).select("tx_dt", "pr_id", "day_cnt", numbers.round_scaled(C("day_ms"), 3).alias("day_ms"))


add("a8_weighted_day_mean", on(_day_stats), DAY_STATS)


def _code_stats(ws: Workspace) -> DataFrame:
    hours = ws.get("rt_pr_hh24_clean").filter(C("tx_dt").isNotNull())
    frame = stats.code_frame(stats.monthly(stats.day_frame(hours)), ["ym"])
    return frame.select("ym", "pr_id", "total_cnt", numbers.round_scaled(C("mean_ms")).alias("mean_ms"),
                        "first_day", "last_day", "active_days")


add("a9_weighted_month_mean", on(_code_stats), """
SELECT ym, pr_id, CAST(sum(n) AS BIGINT) AS total_cnt, round(sum(ms * n) / nullif(sum(n), 0), 2) AS mean_ms,
       min(tx_dt) AS first_day, max(tx_dt) AS last_day, count(tx_dt) AS active_days
FROM (SELECT ym, pr_id, tx_dt, sum(tx_cnt) AS n, sum(avg_tm_ms * tx_cnt) / nullif(sum(tx_cnt), 0) AS ms
      FROM month_hours GROUP BY ALL) GROUP BY ALL""")
add("a10_month_total", on(lambda ws: stats.with_period_total(stats.code_frame(stats.monthly(stats.day_frame(
        ws.get("rt_pr_hh24_clean").filter(C("tx_dt").isNotNull()))), ["ym"]), ["ym"]).select("ym", "all_cnt").distinct()),
    "SELECT ym, CAST(sum(tx_cnt) AS BIGINT) AS all_cnt FROM month_hours GROUP BY ym")
add("a11_host_day", over("monitor_daily", "*"), "SELECT * FROM v12")
add("a12_host_hour", over("monitor_hourly", "*"), "SELECT * FROM v13")
add("a13_jvm_day", over("monitor_daily_jvm", "*"), "SELECT * FROM v14")
add("a14_jvm_hour", over("monitor_hourly_jvm", "*"), "SELECT * FROM v15")
add("a15_distinct_registry", on(lambda ws: monitor.port_applications(ws.get("registry_info"))),
    "SELECT DISTINCT application, ipaddr, port FROM v18")
add("a16_group_by_alias", on(lambda ws: ws.sql(
        "SELECT left(tx_dt_str, 7) AS year_month, pr_id, count(*) AS hours FROM rt_pr_hh24_clean GROUP BY year_month, pr_id")),
    "SELECT left(tx_dt_str, 7) AS year_month, pr_id, count(*) AS hours FROM v3 GROUP BY ALL")
add("a17_pivot", on(lambda ws: spread(reports.history_totals(ws, oracle.P), ["pr_id"], "ym", [F.sum("total_cnt")],
                                      "history totals")), "SELECT * FROM r13")


def _empty_pivot(ws: Workspace) -> DataFrame:
    nowhere = proxies.ReportParams.resolve(target_month="1950-01", history_start_month="1949-01")
    return reports.volume_per_day_pivot(ws, nowhere)


add("a17_pivot_without_data", on(_empty_pivot), """
SELECT 'No data for report 2.1.交易量統計-當月每日-Pivot under current parameters' AS "Message"
WHERE NOT EXISTS (FROM month_hours WHERE ym = '1950-01')""")

# ---------------------------------------------------------------- windows, sorting

add("w1_latest_per_date_code", over("rt_cnt_clean", "pr_id", "tx_dt", "_dt", "total_cnt"),
    "SELECT pr_id, tx_dt, _dt, total_cnt FROM v1")
add("w2_latest_per_date_hour_code", over("rt_pr_hh24_clean", "pr_id", "tx_dt", "tx_hour", "_dt", "tx_cnt"),
    "SELECT pr_id, tx_dt, tx_hour, _dt, tx_cnt FROM v3")
add("w3_latest_sample", over("monitor_log", "monitor_kind", "target_ip", "target_port", "log_createtime", "source_file"),
    "SELECT monitor_kind, target_ip, target_port, log_createtime, source_file FROM v11")


def _slowest_days(ws: Workspace) -> DataFrame:
    hours = ws.get("rt_pr_hh24_clean").filter(C("tx_dt").isNotNull())
    frame = stats.code_frame(stats.monthly(stats.day_frame(hours)), ["ym"])
    return frame.select("ym", "pr_id", C("slow.day").alias("day"), C("slow.cnt").alias("cnt"))


add("w4_slowest_day", on(_slowest_days), f"""
SELECT ym, pr_id, first(tx_dt ORDER BY ms DESC NULLS LAST, tx_dt) AS day, first(n ORDER BY ms DESC NULLS LAST, tx_dt) AS cnt
FROM (SELECT ym, pr_id, tx_dt, CAST(sum(tx_cnt) AS BIGINT) AS n, sum(avg_tm_ms * tx_cnt) / nullif(sum(tx_cnt), 0) AS ms
      FROM month_hours GROUP BY ALL) GROUP BY ALL""")
add("w5_busiest_hour", on(lambda ws: ws.get("rt_pr_hh24_clean").filter(C("tx_dt").isNotNull()).groupBy(
        calendar.month_text(C("tx_dt")).alias("ym"), "pr_id").agg(
        peak(C("tx_hour_ts"), C("tx_cnt"), earlier(C("tx_dt")), -C("tx_hour")).alias("hour"), F.max("tx_cnt").alias("cnt"))),
    """SELECT ym, pr_id, first(tx_hour_ts ORDER BY tx_cnt DESC, tx_hour_ts) AS hour, max(tx_cnt) AS cnt
       FROM month_hours GROUP BY ALL""")
add("w6_ranked_filter", lambda spark, sf_dir: keep_latest(
        proxies.table(spark, sf_dir, "lineitem").withColumns({"_dt": C("l_shipdate"), "_file": C("l_orderkey")}),
        ["l_partkey"], ["l_linenumber"]).drop("_dt", "_file"),
    """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey
       ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1""")
add("o1_mixed_order", on(lambda ws: ws.get("monitor_hourly_jvm").orderBy(
        F.desc_nulls_last("log_date"), F.desc_nulls_last("log_hour"), F.desc_nulls_last("max_used_heap_mem_rate"))),
    "SELECT * FROM v15")
add("o2_top_rows", on(lambda ws: ws.get("rt_node_hh24_clean").select(
        "pr_id", "node_id", "tx_hour_ts", "tx_cnt", "avg_tm_ms").orderBy(
        F.desc("tx_cnt"), F.asc("tx_hour_ts"), F.asc("pr_id"), F.asc("node_id")).limit(exports.MAX_ROWS)),
    """SELECT pr_id, node_id, tx_hour_ts, tx_cnt, avg_tm_ms FROM v4
       ORDER BY tx_cnt DESC, tx_hour_ts, pr_id, node_id LIMIT 10000""")

# ---------------------------------------------------------------- reports


def _codes(ws: Workspace) -> list[str]:
    """All codes that the hourly rows have, whatever the month."""
    rows = ws.get("rt_pr_hh24_clean").filter("pr_id IS NOT NULL").select("pr_id").distinct().orderBy("pr_id")
    return [row.pr_id for row in rows.collect()]


REPORT_KEYS = {
    "r1_volume_of_month": (reports.volume_of_month, oracle.P), "r2_volume_per_day": (reports.volume_per_day, oracle.P),
    "r3_volume_per_day_pivot": (lambda ws, p: reports.volume_per_day_pivot(ws, p, _codes(ws)), oracle.P),
    "r4_peak_day_and_hour": (reports.peak_day_and_hour, oracle.P),
    "r5_peak_day_hours_pivot": (reports.peak_day_hours_pivot, oracle.P),
    "r6_all_categories": (reports.all_categories, oracle.P), "r7_top_updates": (reports.top_updates, oracle.P),
    "r8_top_queries": (reports.top_queries, oracle.P), "r9_month_over_month": (reports.month_over_month, oracle.P),
    "r10_host_summary": (reports.host_summary, oracle.M), "r11_host_day_list": (reports.host_day_list, oracle.M),
    "r12_history_totals": (reports.history_totals, oracle.P),
    "r13_history_totals_pivot": (reports.history_totals_pivot, oracle.P),
    "r14_history_peak_days": (reports.history_peak_days, oracle.P),
    "r15_history_peak_days_pivot": (reports.history_peak_days_pivot, oracle.P),
    "r16_history_peaks": (reports.history_peaks, oracle.P),
    "r17_history_peaks_pivot": (reports.history_peaks_pivot, oracle.P),
    "r18_range_details": (reports.range_details, oracle.P),
    "r19_range_details_compared": (reports.range_details_compared, oracle.P),
    "r20_range_volume_compared": (reports.range_volume_compared, oracle.P),
}
for _key, (_build, _params) in REPORT_KEYS.items():
    add(_key, on(lambda ws, build=_build, p=_params: build(ws, p)), f"SELECT * FROM {_key.split('_')[0]}")


BOUND = """SELECT pr_id, sum(tx_cnt) AS total_cnt FROM rt_pr_hh24_clean
WHERE tx_yyyymm = '${targetMonth}' AND tx_hour_ts <= CAST('${rangeEndTime}' AS TIMESTAMP_NTZ) GROUP BY pr_id"""


def _bound_query(ws: Workspace) -> DataFrame:
    ws.register_views(BOUND)
    return run_query(ws.spark, BOUND, oracle.P)


add("b1_bound_parameters", on(_bound_query), f"""
SELECT pr_id, CAST(sum(tx_cnt) AS BIGINT) AS total_cnt FROM v3
WHERE tx_yyyymm = '{oracle.P.target_month}' AND tx_hour_ts <= TIMESTAMP '{oracle.P.range_end_time}:00' GROUP BY pr_id""")


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = proxies.workspace(spark, sf_dir)
    out = scratch_dir(spark, "batch")
    status = batch.run_reports(ws, oracle.P, f"{out}/reports", work=f"{out}/silver")
    return status.select("number", "rows", "ok")


VOLUME_REPORTS = {"1": "r1", "2": "r2", "2.1": "r3", "3": "r4", "3.1": "r5", "4": "r12", "4.1": "r13", "5": "r14",
                  "5.1": "r15", "6": "r16", "6.1": "r17", "7": "r6", "7.1": "r7", "7.2": "r8", "8": "r18",
                  "8.1": "r19", "8.2": "r20", "8.3": "r9"}
_HOST_RANGE = f"log_date BETWEEN DATE '{oracle.P.range_start_date}' AND DATE '{oracle.P.range_end_date}'"
add("b2_report_run", _batch, " UNION ALL ".join(
    [f"SELECT '{n}' AS number, count(*) AS rows, true AS ok FROM {v}" for n, v in VOLUME_REPORTS.items()]
    + [f"SELECT '1.1', count(DISTINCT (application, target_ip)), true FROM v12 WHERE {_HOST_RANGE}",
       f"SELECT '1.1.1', count(*), true FROM v12 WHERE {_HOST_RANGE}"]))

# ---------------------------------------------------------------- exports and functions

EXPORT_KEYS = {"e1_daily_export": ("monitor_daily", "daily", "e_daily"),
               "e1_daily_jvm_export": ("monitor_daily_jvm", "daily", "e_daily_jvm"),
               "e2_hourly_export": ("monitor_hourly", "hourly", "e_hourly"),
               "e2_hourly_jvm_export": ("monitor_hourly_jvm", "hourly", "e_hourly_jvm")}
for _key, (_dataset, _kind, _view) in EXPORT_KEYS.items():
    add(_key, on(lambda ws, name=_dataset, kind=_kind: exports.export(ws, name, kind)), f"SELECT * FROM {_view}")


def _exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "exports")
    listed = [{"view": view, "filename": task.file_name, "type": task.kind.upper()} for view, task in zip(exports.VIEW_NAMES, exports.TASKS)]
    spark.createDataFrame([(json.dumps({"tasks": listed}),)], "value string").coalesce(1).write.text(f"{out}/tasks")
    tasks = exports.read_tasks(spark, f"{out}/tasks")
    return exports.run_exports(proxies.workspace(spark, sf_dir), f"{out}/monitor", f"{out}/work", tasks)


add("e3_export_tasks", _exports, " UNION ALL ".join(
    f"SELECT '{t.dataset}' AS dataset, '{t.file_name}' AS file_name, '{t.kind}' AS kind, least(count(*), {t.max_rows}) AS rows_written, "
    f"count(*) = 0 AS is_empty, count(*) AS total_rows, count(*) > {t.max_rows} AS truncated FROM {v}_all" for t, v in zip(exports.TASKS, ["e_daily", "e_hourly", "e_daily_jvm", "e_hourly_jvm"])))


def _macros(ws: Workspace) -> DataFrame:
    load_macros(ws.spark)
    ws.get("rt_cnt_clean").createOrReplaceTempView("rt_cnt_clean")
    return ws.spark.sql("""SELECT pr_id, tx_dt, iso_year_week(tx_dt) AS iso_yw, safe_pct(ok_cnt, total_cnt) AS ok_rate,
        republic_date(tx_dt) AS day, share_text(fail_cnt, total_cnt) AS share FROM rt_cnt_clean""")


add("u1_sql_macros", on(_macros), f"""
SELECT pr_id, tx_dt, strftime(tx_dt, '%G-%V') AS iso_yw, round(ok_cnt * 100.0 / nullif(total_cnt, 0), 2) AS ok_rate,
       {oracle.republic('tx_dt')} AS day, concat(CAST(round(fail_cnt * 100.0 / nullif(total_cnt, 0), 2) AS VARCHAR), '%') AS share
FROM v1""")


BETWEEN = f"(DATE'{oracle.P.range_start_date}', DATE'{oracle.P.range_end_date}')"
IN_BETWEEN = f"tx_dt BETWEEN DATE '{oracle.P.range_start_date}' AND DATE '{oracle.P.range_end_date}'"
add("u1_table_functions", on(lambda ws: ws.sql(f"""
    SELECT h.tx_dt, h.pr_id, sum(h.tx_cnt) AS hour_cnt, max(t.avg_tm_ms) AS day_ms, max(c.total_cnt) AS day_cnt
    FROM rt_pr_hh24_between{BETWEEN} h LEFT JOIN rt_tmspt_between{BETWEEN} t ON h.pr_id = t.pr_id AND h.tx_dt = t.tx_dt
    LEFT JOIN rt_cnt_between{BETWEEN} c ON h.pr_id = c.pr_id AND h.tx_dt = c.tx_dt GROUP BY h.tx_dt, h.pr_id""")), f"""
SELECT h.tx_dt, h.pr_id, CAST(sum(h.tx_cnt) AS BIGINT) AS hour_cnt, max(t.avg_tm_ms) AS day_ms, max(c.total_cnt) AS day_cnt
FROM (SELECT * FROM v3 WHERE {IN_BETWEEN}) h LEFT JOIN v2 t ON h.pr_id = t.pr_id AND h.tx_dt = t.tx_dt
LEFT JOIN v1 c ON h.pr_id = c.pr_id AND h.tx_dt = c.tx_dt GROUP BY h.tx_dt, h.pr_id""")
