"""Host and JVM rollups of the monitor log.

The application only depends on host (and port), so the log is aggregated first
and the registry joined to the aggregates: a host with several applications
multiplies a handful of result rows instead of its raw samples.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tallyworks.functions import calendar
from tallyworks.operators.lookup import lookup_left
from tallyworks.operators.measures import max_of, mean_of, merge, min_of, states

HOST_METRICS = ["used_cpu_rate", "used_mem_rate", "total_mem", "used_mem", "used_disk_rate",
                "total_disk", "used_disk"]
HEAP_METRICS = ["used_heap_mem", "max_heap_mem", "used_heap_mem_rate"]
HOST_KEYS = ["target_ip", "log_date"]
JVM_KEYS = ["target_ip", "target_port", "log_date"]


def server_samples(log: DataFrame) -> DataFrame:
    """Server rows with the used memory and disk, dated by day and hour."""
    return log.filter(F.col("monitor_kind") == "SERVER").withColumns({
        "used_disk": F.col("total_disk") - F.col("free_disk"),
        "used_mem": F.col("total_mem") - F.col("free_mem"),
        "log_date": F.col("log_createtime").cast("date"), "log_hour": calendar.hour_of(F.col("log_createtime"))})


def jvm_samples(log: DataFrame) -> DataFrame:
    return log.filter((F.col("monitor_kind") == "JVM") & F.col("used_heap_mem").isNotNull()).withColumns({
        "log_date": F.col("log_createtime").cast("date"), "log_hour": calendar.hour_of(F.col("log_createtime"))})


def host_states(samples: DataFrame, hourly: bool) -> DataFrame:
    return states(samples, HOST_KEYS + (["log_hour"] if hourly else []), HOST_METRICS)


def jvm_states(samples: DataFrame, hourly: bool) -> DataFrame:
    return states(samples, JVM_KEYS + (["log_hour"] if hourly else []), HEAP_METRICS)


def host_days(hours: DataFrame) -> DataFrame:
    """Day states from hour states."""
    return merge(hours, HOST_KEYS, HOST_METRICS)


def jvm_days(hours: DataFrame) -> DataFrame:
    return merge(hours, JVM_KEYS, HEAP_METRICS)


def host_applications(registry: DataFrame) -> DataFrame:
    return registry.select("application", "ipaddr").distinct()


def port_applications(registry: DataFrame) -> DataFrame:
    return registry.select("application", "ipaddr", "port").distinct()


def finish_hosts(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Attach applications to host states and turn the states into figures."""
    apps = host_applications(registry)
    joined = lookup_left(rows, apps, F.col("target_ip") == F.col("ipaddr"))
    hour = ["log_hour"] if "log_hour" in rows.columns else []
    return joined.select(
        "application", "target_ip", "log_date", *hour, "record_count",
        max_of("used_cpu_rate").alias("max_cpu_rate"), min_of("used_cpu_rate").alias("min_cpu_rate"),
        mean_of("used_cpu_rate").alias("avg_cpu_rate"),
        max_of("used_mem_rate").alias("max_mem_rate"), min_of("used_mem_rate").alias("min_mem_rate"),
        mean_of("used_mem_rate").alias("avg_mem_rate"), mean_of("total_mem").alias("avg_total_mem"),
        max_of("used_mem").alias("max_used_mem"), min_of("used_mem").alias("min_used_mem"),
        mean_of("used_mem").alias("avg_used_mem"),
        max_of("used_disk_rate").alias("max_disk_rate"), min_of("used_disk_rate").alias("min_disk_rate"),
        mean_of("used_disk_rate").alias("avg_disk_rate"), mean_of("total_disk").alias("avg_total_disk"),
        max_of("used_disk").alias("max_used_disk"), min_of("used_disk").alias("min_used_disk"),
        mean_of("used_disk").alias("avg_used_disk"))


def _heap_columns() -> list:
    return ["record_count", max_of("used_heap_mem").alias("max_used_heap_mem"),
            min_of("used_heap_mem").alias("min_used_heap_mem"),
            mean_of("used_heap_mem").alias("avg_used_heap_mem"),
            mean_of("max_heap_mem").alias("avg_max_heap_mem"),
            max_of("max_heap_mem").alias("max_max_heap_mem"),
            max_of("used_heap_mem_rate").alias("max_used_heap_mem_rate"),
            min_of("used_heap_mem_rate").alias("min_used_heap_rate"),
            mean_of("used_heap_mem_rate").alias("avg_used_heap_mem_rate")]


def finish_jvm_days(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Ports compare as numbers here: text ``08080`` finds port 8080."""
    apps = port_applications(registry)
    on = ((F.col("target_ip") == F.col("ipaddr"))
          & (F.col("target_port").try_cast("bigint") == F.col("port")))
    joined = lookup_left(rows, apps, on)
    return joined.select("application", "target_ip", "target_port",
                         F.col("log_date").cast("timestamp_ntz").alias("log_date"), *_heap_columns())


def finish_jvm_hours(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Ports compare as text here: ``08080`` does not find port 8080."""
    apps = port_applications(registry)
    on = (F.col("target_ip") == F.col("ipaddr")) & (F.col("target_port") == F.col("port").cast("string"))
    joined = lookup_left(rows, apps, on)
    return joined.select("application", "target_ip", "target_port", "log_date", "log_hour",
                         *_heap_columns())


def monitor_daily(log: DataFrame, registry: DataFrame) -> DataFrame:
    return finish_hosts(host_states(server_samples(log), hourly=False), registry)


def monitor_hourly(log: DataFrame, registry: DataFrame) -> DataFrame:
    return finish_hosts(host_states(server_samples(log), hourly=True), registry)


def monitor_daily_jvm(log: DataFrame, registry: DataFrame) -> DataFrame:
    return finish_jvm_days(jvm_states(jvm_samples(log), hourly=False), registry)


def monitor_hourly_jvm(log: DataFrame, registry: DataFrame) -> DataFrame:
    return finish_jvm_hours(jvm_states(jvm_samples(log), hourly=True), registry)


def four_rollups(hosts: DataFrame, jvms: DataFrame, registry: DataFrame) -> dict[str, DataFrame]:
    """All four rollups from written hour states, so the log is read once per kind."""
    return {
        "monitor_daily": finish_hosts(host_days(hosts), registry),
        "monitor_hourly": finish_hosts(hosts, registry),
        "monitor_daily_jvm": finish_jvm_days(jvm_days(jvms), registry),
        "monitor_hourly_jvm": finish_jvm_hours(jvms, registry),
    }


def days_holding(index: Sequence[Row], kind: str, first: dt.date, last: dt.date | None = None) -> list[str]:
    """Landed days that can hold samples of a kind in a date range."""
    return [row["_dt"] for row in index if row["monitor_kind"] == kind and row["last"] is not None
            and row["last"] >= first and (last is None or row["first"] <= last)]


def sheet_between(sheet: DataFrame, index: Sequence[Row], kind: str, first: dt.date,
                  last: dt.date | None = None) -> DataFrame:
    """Raw log rows of a kind, from the first landed day that matters to the last.

    All versions of a sample share its time, so every day that could hold one of
    them is kept and the dedup downstream stays exact.
    """
    days = days_holding(index, kind, first, last)
    rows = sheet.filter(F.col("monitor_kind") == kind)
    return rows.filter(F.col("_dt").between(min(days), max(days))) if days else rows.filter(F.lit(False))
