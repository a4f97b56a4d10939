"""Clean layer: typed dates out of year-less keys, restated rows reduced to the newest.

For the key-dated sheets the year repair guarantees ``tx_dt <= file date < tx_dt
+ 1 year``, so a wanted date range bounds the ``_dt`` partitions that can hold
any version of its rows. Catalyst cannot see that through the date
arithmetic; ``key_dated`` adds the partition predicate itself.

``all_versions`` leaves the reduction out; the tables kept by ``incremental`` do it themselves.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import calendar, text
from tallyworks.operators.dedup import keep_latest
from tallyworks.sources.schemas import CONTENT_PREFIXES

LINEAGE = ["_file", "_sheet", "_dt", "_ingest_ts"]

# a file dates a row at most one year back; one spare day covers 29 February
MAX_FILE_LAG_DAYS = 367


def _day(value: str | dt.date | None) -> dt.date | None:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def within(df: DataFrame, from_date=None, to_date=None, column: str = "tx_dt") -> DataFrame:
    first, last = _day(from_date), _day(to_date)
    if first is not None:
        df = df.filter(F.col(column) >= F.lit(first))
    if last is not None:
        df = df.filter(F.col(column) <= F.lit(last))
    return df


def key_dated(sheet: DataFrame, key: str, from_date=None, to_date=None) -> DataFrame:
    """Add ``file_dt`` and ``tx_dt``; prune the ``_dt`` partitions to the wanted dates."""
    first, last = _day(from_date), _day(to_date)
    if first is not None:
        sheet = sheet.filter(F.col("_dt") >= first.strftime("%Y%m%d"))
    if last is not None:
        limit = last + dt.timedelta(days=MAX_FILE_LAG_DAYS)
        sheet = sheet.filter(F.col("_dt") <= limit.strftime("%Y%m%d"))
    dated = sheet.withColumn("file_dt", calendar.file_date(F.col("_dt")))
    dated = dated.withColumn("tx_dt", calendar.date_from_key(F.col(key), F.col("file_dt")))
    return within(dated, first, last)


def _day_columns(df: DataFrame) -> DataFrame:
    day = F.col("tx_dt")
    return df.withColumns({
        "file_dt_str": calendar.day_text(F.col("file_dt")),
        "tx_dt_str": calendar.day_text(day),
        "tx_year": F.year(day), "tx_month": F.month(day), "tx_day": F.dayofmonth(day),
        "tx_yyyymm": calendar.month_text(day),
    })


def rt_cnt_clean(sheet: DataFrame, all_versions: bool = False) -> DataFrame:
    """Day counts per code. The date comes from the first transaction's time when
    it parses, else from the key, so file dates cannot be pruned here."""
    dated = key_dated(sheet, "caldy").withColumnRenamed("tx_dt", "_key_dt")
    dated = dated.withColumns({
        "tx_ts_first": calendar.iso_stamp(F.col("first_tx_raw")),
        "tx_ts_last": calendar.iso_stamp(F.col("last_tx_raw")),
    })
    dated = dated.withColumn("tx_dt", F.coalesce(F.col("tx_ts_first").cast("date"), F.col("_key_dt")))
    newest = dated if all_versions else keep_latest(dated, ["tx_dt", "pr_id"], ["total_cnt", "ok_cnt", "fail_cnt", "timeout_cnt"])
    return _day_columns(newest).select(
        "caldy", "pr_id", "total_cnt", "ok_cnt", "fail_cnt", "rev_ok_cnt", "timeout_cnt",
        "other_err_cnt", "file_dt", "file_dt_str", "tx_ts_first", "tx_ts_last", "first_tx_raw",
        "last_tx_raw", "tx_dt", "tx_dt_str", "tx_year", "tx_month", "tx_day", "tx_yyyymm",
        (F.col("caldy") == calendar.month_day_text(F.col("tx_dt"))).alias("caldy_match_txdt"), *LINEAGE)


def rt_tmspt_clean(sheet: DataFrame, from_date=None, to_date=None, pad_codes: bool = False, all_versions: bool = False) -> DataFrame:
    """Mean time per code and day; rows without a date drop.

    The source's code pattern never matches an ordinary code, so ``pr_id_norm``
    repeats the code. ``pad_codes`` gives what the pattern was meant to do.
    """
    dated = key_dated(sheet, "caldy", from_date, to_date).filter(F.col("tx_dt").isNotNull())
    newest = dated if all_versions else keep_latest(dated, ["tx_dt", "pr_id"], ["avg_tm"])
    code = F.col("pr_id")
    return _day_columns(newest).select(
        "pr_id", (text.padded_code(code) if pad_codes else code).alias("pr_id_norm"), "caldy",
        F.col("avg_tm").alias("avg_tm_sec"), (F.col("avg_tm") * 1000).alias("avg_tm_ms"),
        "tx_dt", "tx_dt_str", "file_dt", "file_dt_str", "tx_year", "tx_month", "tx_day",
        "tx_yyyymm", *LINEAGE)


def _hour_columns(df: DataFrame) -> DataFrame:
    stamp = calendar.hour_stamp(F.col("tx_dt"), F.col("tx_hour"))
    return _day_columns(df).withColumns({
        "avg_tm_sec": F.col("avg_tm"), "avg_tm_ms": F.col("avg_tm") * 1000, "tx_cnt": F.col("cnt"),
        # whole hours, so the plain text form is already the hour label
        "tx_hour_ts": stamp, "tx_hour_ts_str": stamp.cast("string"),
    })


HOURLY = ["caltm", "avg_tm_sec", "avg_tm_ms", "tx_cnt", "file_dt", "file_dt_str", "tx_dt", "tx_dt_str",
          "tx_year", "tx_month", "tx_day", "tx_yyyymm", "tx_hour", "tx_hour_ts", "tx_hour_ts_str"]


def rt_pr_hh24_clean(sheet: DataFrame, from_date=None, to_date=None, all_versions: bool = False) -> DataFrame:
    """Hourly counts and mean times per code, one row per date, hour and code."""
    dated = key_dated(sheet, "caltm", from_date, to_date).withColumns({
        "pr_id": F.trim("pr_id"), "tx_hour": calendar.key_part(F.col("caltm"), 6)})
    # date and code first: the rows come out sorted for the day frame's aggregate
    newest = dated if all_versions else keep_latest(dated, ["tx_dt", "pr_id", "tx_hour"], ["cnt", "avg_tm"])
    return _hour_columns(newest).select("pr_id", *HOURLY, *LINEAGE)


def rt_node_hh24_clean(sheet: DataFrame, from_date=None, to_date=None) -> DataFrame:
    """Hourly counts per code and node. Restated rows are kept, as in the source."""
    dated = key_dated(sheet, "caltm", from_date, to_date).withColumns({
        "pr_id": F.trim("pr_id"), "node_id": F.trim("node_id"),
        "tx_hour": calendar.key_part(F.col("caltm"), 6)})
    match = F.substring("caltm", 1, 4) == calendar.month_day_text(F.col("tx_dt"))
    return _hour_columns(dated).select("pr_id", "node_id", *HOURLY, match.alias("caltm_match_txdt"), *LINEAGE)


SERVER_METRICS = ["used_cpu_rate", "total_mem", "free_mem", "used_mem_rate", "total_disk", "free_disk",
                  "used_disk_rate"]
JVM_METRICS = ["used_heap_mem", "max_heap_mem", "used_heap_mem_rate"]


def log_rows(sheet: DataFrame) -> DataFrame:
    """Log rows that name a host and a kind, with their parsed time."""
    kept = sheet.filter((F.col("target_ip") != "") & F.col("monitor_kind").isNotNull())
    return kept.withColumn("log_createtime", calendar.loose_stamp(F.col("createtime")))


def log_days(sheet: DataFrame) -> DataFrame:
    """First and last log date per landed day and kind.

    Nothing ties a sample's time to the day of its file, so this narrow pass (no
    text is read, one row per task and day is moved) tells which landed days can
    hold samples of a date range.
    """
    date = F.col("log_createtime").cast("date")
    rows = log_rows(sheet).filter(F.col("monitor_kind").isin("SERVER", "JVM"))
    return rows.groupBy("_dt", "monitor_kind").agg(F.min(date).alias("first"),
                                                              F.max(date).alias("last"))


def monitor_log(sheet: DataFrame, prefixes: Sequence[str] = CONTENT_PREFIXES, all_versions: bool = False) -> DataFrame:
    """Metrics out of the monitor text, one row per kind, host, port and time.

    Metrics are cut out before the shuffle: a few narrow decimals then travel in
    place of the text, and the tie between equal versions is broken by a hash of
    the text.
    """
    # its own column: used by eleven expressions, the text is cut once per row
    kept = log_rows(sheet).withColumn("_body", text.without_prefixes(F.col("mon_content"), prefixes))
    body = F.col("_body")

    def only(kind: str, value):
        return F.when(F.col("monitor_kind") == kind, value)

    # fixed values: the metric names inside the text
    parsed = kept.withColumns({
        "used_cpu_rate": only("SERVER", text.rate(body, "usedCPURate")),
        "total_mem": only("SERVER", text.size(body, "totalMem")),
        "free_mem": only("SERVER", text.size(body, "freeMem")),
        "used_mem_rate": only("SERVER", text.rate(body, "usedMemRate")),
        "total_disk": only("SERVER", text.size(body, "totalDisk")),
        "free_disk": only("SERVER", text.size(body, "freeDisk")),
        "used_disk_rate": only("SERVER", text.rate(body, "usedDiskRate")),
        "used_heap_mem": only("JVM", text.size(body, "usedHeapMem")),
        "max_heap_mem": only("JVM", text.size(body, "maxHeapMem")),
        "used_heap_mem_rate": only("JVM", text.rate(body, "usedMemRate")),
        "db_conn_status": only("DB_CONN", text.rest_of_line(body, "dbConnStatus")),
        "_content_hash": F.xxhash64("mon_content"),
    })
    # time first: it tells most rows apart, so the sorts seldom compare text
    newest = parsed if all_versions else keep_latest(parsed, ["log_createtime", "target_ip", "target_port", "monitor_kind"],
                                                     ["_content_hash"])
    return newest.select(
        "monitor_kind", "target_ip", "target_port", "log_createtime", *SERVER_METRICS, *JVM_METRICS,
        "db_conn_status", F.col("mon_content").alias("log_content"), F.col("_file").alias("source_file"),
        F.col("_sheet").alias("source_sheet"), F.col("_dt").alias("report_dt"),
        F.col("_ingest_ts").alias("ingest_timestamp"))


def pr_info(codes: DataFrame) -> DataFrame:
    return codes.select(F.col("seq_no").cast("int").alias("seq_no"), "pr_id",
                        F.col("pr_category").alias("category"), F.col("pr_name").alias("name"))


def registry(rows: DataFrame) -> DataFrame:
    return rows.select("application", "ipaddr", F.col("port").cast("bigint").alias("port"))
