"""Sheets rebuilt from the driver's tables, once as DataFrames and once as SQL.

The sheets this engine reads are not shipped anywhere, so each is a
deterministic view of ``orders``, ``lineitem``, ``events`` or ``supplier``. Means
are formed from exact integer sums, so both engines see the same doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.calendar import month_day_text
from tallyworks.functions.numbers import round_scaled
from tallyworks.plans.params import ReportParams
from tallyworks.plans.workspace import Workspace

PREFIXES = ("[view] ", "[click] ", "[error] ", "[signup] ", "[purchase] ")
EXCLUDED = ("1-URGENT",)
TARGET_MONTH = "1998-05"

SQL: dict[str, str] = {}


def params() -> ReportParams:
    return ReportParams.resolve(target_month=TARGET_MONTH, history_start_month="1998-01",
                                history_end_month="1998-06")


def monitor_params() -> ReportParams:
    return ReportParams.resolve(range_start_date="2024-01-05", range_end_date="2024-01-20",
                                history_start_month="2023-09")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(column: str) -> Column:
    return F.col(column).cast("date")


def _compact(day: Column) -> Column:
    return F.replace(day.cast("string"), F.lit("-"), F.lit(""))


def _lineage(df: DataFrame, sheet: str, file: Column | None = None) -> DataFrame:
    return df.withColumns({"_file": F.concat(F.lit("F"), F.col("_dt")) if file is None else file,
                           "_sheet": F.lit(sheet), "_ingest_ts": F.lit(0).cast("bigint")})


def _sql_lineage(sheet: str, file: str = "'F' || _dt") -> str:
    return f"{file} AS _file, '{sheet}' AS _sheet, CAST(0 AS BIGINT) AS _ingest_ts"


def rt_cnt(orders: DataFrame) -> DataFrame:
    """Day counts per priority, filed the next day; every third day is restated a day later."""
    day = F.col("day")
    base = orders.select(_day("o_orderdate").alias("day"), F.col("o_orderpriority").alias("pr_id"),
                         "o_orderstatus")

    def status(name: str) -> Column:
        return F.count(F.when(F.col("o_orderstatus") == name, 1))

    counts = base.groupBy("day", "pr_id").agg(
        F.count(F.lit(1)).alias("total_cnt"), status("F").alias("ok_cnt"), status("O").alias("fail_cnt"),
        status("P").alias("timeout_cnt"))
    restated = F.when(F.dayofmonth(day) % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = counts.withColumn("version", F.explode(restated))
    first = (F.col("version") == 0) & (F.dayofmonth(day) % 2 == 0)
    zero = F.lit(0).cast("bigint")

    def stamp(time: str) -> Column:
        return F.when(first, F.concat(day.cast("string"), F.lit(time)))

    rows = rows.select(
        month_day_text(day).alias("caldy"), "pr_id",
        (F.col("total_cnt") + F.col("version")).alias("total_cnt"),
        (F.col("ok_cnt") + F.col("version")).alias("ok_cnt"), "fail_cnt", zero.alias("rev_ok_cnt"),
        "timeout_cnt", zero.alias("other_err_cnt"), stamp("T08:00:00.000000").alias("first_tx_raw"),
        stamp("T20:00:00.000000").alias("last_tx_raw"),
        _compact(F.date_add(day, F.col("version") + 1)).alias("_dt"))
    return _lineage(rows, "RT_CNT")


SQL["rt_cnt"] = f"""
SELECT *, {_sql_lineage('RT_CNT')} FROM (
  SELECT strftime(d, '%m%d') AS caldy, pr_id, n + v AS total_cnt, f + v AS ok_cnt, o AS fail_cnt,
         CAST(0 AS BIGINT) AS rev_ok_cnt, p AS timeout_cnt, CAST(0 AS BIGINT) AS other_err_cnt,
         CASE WHEN v = 0 AND day(d) % 2 = 0 THEN strftime(d, '%Y-%m-%d') || 'T08:00:00.000000' END AS first_tx_raw,
         CASE WHEN v = 0 AND day(d) % 2 = 0 THEN strftime(d, '%Y-%m-%d') || 'T20:00:00.000000' END AS last_tx_raw,
         strftime(d + CAST(v + 1 AS INT), '%Y%m%d') AS _dt
  FROM (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS pr_id, count(*) AS n,
               count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o,
               count(*) FILTER (WHERE o_orderstatus = 'P') AS p
        FROM orders GROUP BY 1, 2)
  JOIN (VALUES (0), (1)) versions(v) ON v = 0 OR day(d) % 3 = 0)"""


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def _mean(total: Column, count: Column, scale: float) -> Column:
    return round_scaled(total.cast("double") / (count.cast("double") * F.lit(scale)), 3)


def rt_pr_hh24(orders: DataFrame) -> DataFrame:
    """Hourly counts per priority; codes carry spaces to be trimmed; every fifth day is restated."""
    hour = F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0")
    rows = orders.groupBy(_day("o_orderdate").alias("day"), F.col("o_orderpriority").alias("code"),
                          hour.alias("hour")).agg(F.sum(_cents("o_totalprice")).alias("cents"),
                                                  F.count(F.lit(1)).alias("cnt"))
    day = F.col("day")
    restated = F.when(F.dayofmonth(day) % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("version", F.explode(restated)).select(
        F.concat(F.lit(" "), F.col("code"), F.lit(" ")).alias("pr_id"),
        F.concat(month_day_text(day), F.lit(" "), F.col("hour")).alias("caltm"),
        _mean(F.col("cents"), F.col("cnt"), 1e5).alias("avg_tm"),
        (F.col("cnt") + F.col("version")).alias("cnt"),
        _compact(F.date_add(day, F.col("version") + 1)).alias("_dt"))
    return _lineage(rows, "RT_PR_HH24")


SQL["rt_pr_hh24"] = f"""
SELECT *, {_sql_lineage('RT_PR_HH24')} FROM (
  SELECT ' ' || code || ' ' AS pr_id, strftime(d, '%m%d') || ' ' || lpad(CAST(h AS VARCHAR), 2, '0') AS caltm,
         round(CAST(cents AS DOUBLE) / (CAST(n AS DOUBLE) * 1e5), 3) AS avg_tm, n + v AS cnt,
         strftime(d + CAST(v + 1 AS INT), '%Y%m%d') AS _dt
  FROM (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS code, o_orderkey % 24 AS h, count(*) AS n,
               sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
        FROM orders GROUP BY 1, 2, 3)
  JOIN (VALUES (0), (1)) versions(v) ON v = 0 OR day(d) % 5 = 0)"""


def rt_tmspt(orders: DataFrame) -> DataFrame:
    rows = orders.groupBy(_day("o_orderdate").alias("day"), F.col("o_orderpriority").alias("pr_id")).agg(
        F.sum(_cents("o_totalprice")).alias("cents"), F.count(F.lit(1)).alias("n"))
    rows = rows.select("pr_id", month_day_text(F.col("day")).alias("caldy"),
                       _mean(F.col("cents"), F.col("n"), 1e5).alias("avg_tm"),
                       _compact(F.date_add("day", 1)).alias("_dt"))
    return _lineage(rows, "RT_TMSPT")


SQL["rt_tmspt"] = f"""
SELECT *, {_sql_lineage('RT_TMSPT')} FROM (
  SELECT pr_id, strftime(d, '%m%d') AS caldy,
         round(CAST(cents AS DOUBLE) / (CAST(n AS DOUBLE) * 1e5), 3) AS avg_tm, strftime(d + 1, '%Y%m%d') AS _dt
  FROM (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS pr_id, count(*) AS n,
               sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY 1, 2))"""


def rt_node_hh24(lineitem: DataFrame) -> DataFrame:
    hour = F.lpad((F.col("l_orderkey") % 24).cast("string"), 2, "0")
    rows = lineitem.groupBy(
        F.concat("l_returnflag", "l_linestatus").alias("pr_id"),
        F.concat(F.lit("N"), (F.col("l_suppkey") % 4).cast("string")).alias("node_id"),
        _day("l_shipdate").alias("day"), hour.alias("hour")).agg(
        F.sum(_cents("l_quantity")).alias("cents"), F.count(F.lit(1)).alias("cnt"))
    rows = rows.select("pr_id", "node_id",
                       F.concat(month_day_text(F.col("day")), F.lit(" "), F.col("hour")).alias("caltm"),
                       _mean(F.col("cents"), F.col("cnt"), 100.0).alias("avg_tm"), "cnt",
                       _compact(F.date_add("day", 1)).alias("_dt"))
    return _lineage(rows, "RT_NODE_HH24")


SQL["rt_node_hh24"] = f"""
SELECT *, {_sql_lineage('RT_NODE_HH24')} FROM (
  SELECT pr_id, node_id, strftime(d, '%m%d') || ' ' || lpad(CAST(h AS VARCHAR), 2, '0') AS caltm,
         round(CAST(cents AS DOUBLE) / (CAST(n AS DOUBLE) * 1e2), 3) AS avg_tm, n AS cnt,
         strftime(d + 1, '%Y%m%d') AS _dt
  FROM (SELECT l_returnflag || l_linestatus AS pr_id, 'N' || CAST(l_suppkey % 4 AS VARCHAR) AS node_id,
               CAST(l_shipdate AS DATE) AS d, l_orderkey % 24 AS h, count(*) AS n,
               sum(CAST(round(l_quantity * 100) AS BIGINT)) AS cents
        FROM lineitem GROUP BY 1, 2, 3, 4))"""


def codes(orders: DataFrame) -> DataFrame:
    """One code is left out, so inner joins drop it; one has no name."""
    code = F.col("o_orderpriority")
    rows = orders.select("o_orderpriority").distinct().filter(code != "4-NOT SPECIFIED")
    name = F.when(code != "5-LOW", F.concat(F.lit("name "), code))
    return rows.select(F.substring(code, 1, 1).cast("int").alias("seq_no"), code.alias("pr_id"),
                       name.alias("pr_name"),
                       F.when(code < "3", F.lit("update")).otherwise(F.lit("query")).alias("pr_category"),
                       name.alias("pr_name_adj"))


SQL["codes"] = """
SELECT CAST(left(c, 1) AS INT) AS seq_no, c AS pr_id, CASE WHEN c <> '5-LOW' THEN 'name ' || c END AS pr_name,
       CASE WHEN c < '3' THEN 'update' ELSE 'query' END AS pr_category,
       CASE WHEN c <> '5-LOW' THEN 'name ' || c END AS pr_name_adj
FROM (SELECT DISTINCT o_orderpriority AS c FROM orders) WHERE c <> '4-NOT SPECIFIED'"""


def mon_log(events: DataFrame) -> DataFrame:
    """Monitor text; times are cut to ten minutes so samples collide, some CPU values are N/A."""
    eid, kind = F.col("event_id"), F.col("event_type")
    server = kind.isin("view", "click")

    def number(value: Column, tail: str) -> Column:
        return F.concat(value.cast("string"), F.lit(tail))

    cpu = F.when(eid % 10 == 0, F.lit("N/A%")).otherwise(number(eid % 100, ".25%"))
    host = F.concat(F.lit("usedCPURate:"), cpu, F.lit(",totalMem:4096.00,freeMem:"), number(eid % 4096, ".50"),
                    F.lit(",usedMemRate:"), number(eid % 97, ".10%"), F.lit(",totalDisk:500.00,freeDisk:"),
                    number(eid % 500, ".75"), F.lit(",usedDiskRate:"), number(eid % 89, ".00%"))
    heap = F.concat(F.lit("usedHeapMem:"), number(eid % 2048, ".10"), F.lit(",maxHeapMem:2048.00,usedMemRate:"),
                    number(eid % 100, ".50%"))
    conn = F.concat(F.lit("dbConnStatus:"), F.when(F.col("user_id") % 2 == 0, F.lit("OK")).otherwise(F.lit("FAIL")))
    rows = events.select(
        F.when(server, F.lit("SERVER")).when(kind == "error", F.lit("DB_CONN")).otherwise(F.lit("JVM")).alias("monitor_kind"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 10).cast("string")).alias("target_ip"),
        (F.col("user_id") % 3 + 8080).cast("string").alias("target_port"),
        F.concat(F.lit("["), kind, F.lit("] "),
                 F.when(server, host).when(kind == "error", conn).otherwise(heap)).alias("mon_content"),
        F.concat(F.substring(F.col("ts").cast("string"), 1, 15), F.lit("0:00")).alias("createtime"),
        _compact(F.date_add(_day("ts"), 1)).alias("_dt"), eid.cast("string").alias("_event"))
    return _lineage(rows, "MON_LOG", F.col("_event")).drop("_event")


SQL["mon_log"] = f"""
SELECT * EXCLUDE (e), {_sql_lineage('MON_LOG', 'CAST(e AS VARCHAR)')} FROM (
  SELECT CASE WHEN event_type IN ('view', 'click') THEN 'SERVER' WHEN event_type = 'error' THEN 'DB_CONN'
              ELSE 'JVM' END AS monitor_kind,
         '10.0.0.' || CAST(user_id % 10 AS VARCHAR) AS target_ip, CAST(8080 + user_id % 3 AS VARCHAR) AS target_port,
         '[' || event_type || '] ' || CASE
           WHEN event_type IN ('view', 'click') THEN
             'usedCPURate:' || CASE WHEN event_id % 10 = 0 THEN 'N/A%' ELSE (event_id % 100) || '.25%' END
             || ',totalMem:4096.00,freeMem:' || (event_id % 4096) || '.50,usedMemRate:' || (event_id % 97)
             || '.10%,totalDisk:500.00,freeDisk:' || (event_id % 500) || '.75,usedDiskRate:' || (event_id % 89) || '.00%'
           WHEN event_type = 'error' THEN 'dbConnStatus:' || CASE WHEN user_id % 2 = 0 THEN 'OK' ELSE 'FAIL' END
           ELSE 'usedHeapMem:' || (event_id % 2048) || '.10,maxHeapMem:2048.00,usedMemRate:' || (event_id % 100) || '.50%'
         END AS mon_content,
         strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS createtime,
         strftime(ts + INTERVAL 1 DAY, '%Y%m%d') AS _dt, event_id AS e
  FROM events)"""


def registry(supplier: DataFrame) -> DataFrame:
    """Hosts .8 and .9 have no entry; some hosts carry several applications."""
    return supplier.select(
        F.concat(F.lit("APP-"), (F.col("s_nationkey") % 3).cast("string")).alias("application"),
        F.concat(F.lit("10.0.0."), (F.col("s_suppkey") % 8).cast("string")).alias("ipaddr"),
        (F.col("s_suppkey") % 3 + 8080).cast("bigint").alias("port"))


SQL["registry"] = """
SELECT 'APP-' || CAST(s_nationkey % 3 AS VARCHAR) AS application, '10.0.0.' || CAST(s_suppkey % 8 AS VARCHAR) AS ipaddr,
       CAST(8080 + s_suppkey % 3 AS BIGINT) AS port
FROM supplier"""


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    orders = table(spark, sf_dir, "orders")
    return Workspace(spark, {
        "rt_cnt": rt_cnt(orders), "rt_pr_hh24": rt_pr_hh24(orders), "rt_tmspt": rt_tmspt(orders),
        "rt_node_hh24": rt_node_hh24(table(spark, sf_dir, "lineitem")), "codes": codes(orders),
        "mon_log": mon_log(table(spark, sf_dir, "events")),
        "registry": registry(table(spark, sf_dir, "supplier")),
        "cfg_codes": table(spark, sf_dir, "customer"),
    }, prefixes=PREFIXES, excluded_codes=EXCLUDED)


def raw_sheet(orders: DataFrame) -> DataFrame:
    """Decoded sheet rows before landing, one per order: typed cells, blank cells and
    wholly blank rows, one workbook per month, and files that are no workbook."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    month = _compact(F.trunc(day.cast("date"), "month"))
    blank = key % 50 == 0

    def cell(value: Column) -> Column:
        return F.when(~blank, value)

    return orders.select(
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("notes-"), month, F.lit(".txt")))
         .otherwise(F.concat(F.lit("daily-"), month, F.lit(".xlsx"))).alias("_file"),
        F.when(blank | (key % 7 == 0), F.lit("  ")).otherwise(month_day_text(day.cast("date"))).alias("CALDY"),
        cell(F.col("o_orderpriority")).alias("PR_ID"), cell(key.cast("double")).alias("ORDER_NO"),
        cell(F.col("o_totalprice")).alias("AMOUNT"),
        cell(day + F.make_dt_interval(F.lit(0), (key % 3).cast("int"), F.lit(0),
                                      (key % 2 / 2).cast("decimal(18,6)"))).alias("FIRST"))


SQL["raw_sheet"] = """
SELECT CASE WHEN o_orderstatus = 'P' THEN 'notes-' || m || '.txt' ELSE 'daily-' || m || '.xlsx' END AS _file,
       CASE WHEN b OR o_orderkey % 7 = 0 THEN '  ' ELSE strftime(o_orderdate, '%m%d') END AS "CALDY",
       CASE WHEN NOT b THEN o_orderpriority END AS "PR_ID",
       CASE WHEN NOT b THEN CAST(o_orderkey AS DOUBLE) END AS "ORDER_NO",
       CASE WHEN NOT b THEN o_totalprice END AS "AMOUNT",
       CASE WHEN NOT b THEN o_orderdate + to_hours(CAST(o_orderkey % 3 AS INT))
                            + to_milliseconds(500 * CAST(o_orderkey % 2 AS INT)) END AS "FIRST"
FROM (SELECT *, strftime(o_orderdate, '%Y%m') || '01' AS m, o_orderkey % 50 = 0 AS b FROM orders)"""

SQL["landed_sheet"] = """
SELECT _file, regexp_extract(_file, '(\\d{8})', 1) AS _dt,
       CASE WHEN trim("CALDY") <> '' THEN "CALDY" END AS "CALDY", "PR_ID",
       CAST(CAST("ORDER_NO" AS BIGINT) AS VARCHAR) AS "ORDER_NO",
       CASE WHEN "AMOUNT" = floor("AMOUNT") THEN CAST(CAST("AMOUNT" AS BIGINT) AS VARCHAR)
            ELSE CAST("AMOUNT" AS VARCHAR) END AS "AMOUNT",
       CASE WHEN "FIRST" = date_trunc('day', "FIRST") THEN strftime("FIRST", '%Y-%m-%d')
            ELSE strftime("FIRST", '%Y-%m-%dT%H:%M:%S.%f') END AS "FIRST"
FROM raw_sheet WHERE _file LIKE 'daily-%' AND "PR_ID" IS NOT NULL"""
