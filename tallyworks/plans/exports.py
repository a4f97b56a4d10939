"""Trailing-window extracts of the monitor rollups."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators.trailing import trailing_days
from tallyworks.plans import clean, monitor
from tallyworks.plans.workspace import Workspace
from tallyworks.session import AT_ONCE, at_once
from tallyworks.sources.csvout import write_csv
from tallyworks.sources.schemas import LABELS

# Days kept per kind of extract, and the greatest number of rows delivered.
WINDOW_DAYS = {"daily": 10, "hourly": 4}
MAX_ROWS = 10_000


@dataclass(frozen=True)
class ExportTask:
    """One extract; ``max_rows`` cuts it off (None: all rows), and the status then says so."""

    dataset: str
    file_name: str
    kind: str
    max_rows: int | None = MAX_ROWS


# The names of the rollups in task files.
VIEW_NAMES = {
    "v_prod_monitor_daily_count": "monitor_daily", "v_prod_monitor_hourly_count": "monitor_hourly",
    "v_prod_monitor_daily_jvm_count": "monitor_daily_jvm", "v_prod_monitor_hourly_jvm_count": "monitor_hourly_jvm",
}

# The delivered extracts.
TASKS = (
    ExportTask("monitor_daily", "daily_data", "daily"),
    ExportTask("monitor_hourly", "hourly_data", "hourly"),
    ExportTask("monitor_daily_jvm", "jvm_daily_data", "daily"),
    ExportTask("monitor_hourly_jvm", "jvm_hourly_data", "hourly"),
)


def export_order(df: DataFrame, kind: str) -> list[Column]:
    """Application, host, newest first; further key columns make the order total."""
    order = [F.asc_nulls_last("application"), F.asc_nulls_last("target_ip"), F.desc_nulls_last("log_date")]
    if kind == "hourly":
        order.append(F.desc_nulls_last("log_hour"))
    if "target_port" in df.columns:
        order.append(F.asc_nulls_last("target_port"))
    return order


def recent_rows(df: DataFrame, kind: str) -> DataFrame:
    """The newest days of a rollup."""
    if kind.lower() not in WINDOW_DAYS:
        raise ValueError(f"unsupported export kind: {kind}")
    return trailing_days(df, "log_date", WINDOW_DAYS[kind.lower()])


def export_rows(df: DataFrame, kind: str, rows: int | None = MAX_ROWS) -> DataFrame:
    """The newest days of a rollup in delivered order; with ``rows``, that many at most."""
    ordered = recent_rows(df, kind).orderBy(*export_order(df, kind.lower()))
    return ordered if rows is None else ordered.limit(rows)


def read_tasks(spark: SparkSession, path: str) -> tuple[ExportTask, ...]:
    """The tasks of a JSON task file: ``tasks`` with ``view``, ``filename``, ``type`` and, if wanted, ``max_rows``.

    Datasets may go by the file's view names or by their own.
    """
    text = "".join(row[0] for row in spark.read.text(path, wholetext=True).collect())
    found = []
    for task in json.loads(text).get("tasks") or []:
        dataset = VIEW_NAMES.get(task["view"], task["view"])
        kind = str(task.get("type") or "").strip().lower()
        if kind not in WINDOW_DAYS:
            raise ValueError(f"unsupported export kind: {task.get('type')}")
        found.append(ExportTask(dataset, task["filename"], kind, task.get("max_rows", MAX_ROWS)))
    return tuple(found)


def recent_samples(ws: Workspace, kind: str, index: list[Row], days: int) -> DataFrame:
    """Samples of a kind from ``days`` before its last sampled date on.

    The last date of the raw rows bounds the last date of the samples. It is only
    greater when the newest versions of all rows there lack the metric; then
    the window moves back to the true last date.
    """
    samples = monitor.server_samples if kind == "SERVER" else monitor.jvm_samples
    window = dt.timedelta(days=days)
    last = max((row["last"] for row in index if row["monitor_kind"] == kind and row["last"]), default=None)
    if last is None:
        return samples(ws.log_of(kind, [], dt.date.max))
    found = samples(ws.log_of(kind, index, last - window))
    if kind == "SERVER":
        return found
    true_last = found.agg(F.max("log_date")).first()[0]
    if true_last is None:
        return samples(clean.monitor_log(ws.get("mon_log"), ws.prefixes))
    return found if true_last == last else samples(ws.log_of(kind, index, true_last - window))


def recent_rollup(ws: Workspace, dataset: str, kind: str) -> DataFrame:
    """The newest days of a rollup. The bound of a monitor rollup is known from the log's day index before it is planned, so that only the
    landed days that matter are read, once; other datasets are bounded by their own last date."""
    if dataset not in VIEW_NAMES.values() or dataset in ws.frames or "monitor_log" in ws.frames:
        return recent_rows(ws.get(dataset), kind)
    if kind.lower() not in WINDOW_DAYS:
        raise ValueError(f"unsupported export kind: {kind}")
    hourly, days = "hourly" in dataset, WINDOW_DAYS[kind.lower()]
    registry = ws.get("registry_info")
    if "jvm" in dataset:
        states = monitor.jvm_states(recent_samples(ws, "JVM", ws.log_index(), days), hourly)
        return (monitor.finish_jvm_hours if hourly else monitor.finish_jvm_days)(states, registry)
    return monitor.finish_hosts(monitor.host_states(recent_samples(ws, "SERVER", ws.log_index(), days), hourly), registry)


def export(ws: Workspace, dataset: str, kind: str, rows: int | None = MAX_ROWS) -> DataFrame:
    """One extract by itself, in delivered order."""
    recent = recent_rollup(ws, dataset, kind)
    ordered = recent.orderBy(*export_order(recent, kind.lower()))
    return ordered if rows is None else ordered.limit(rows)


def write_rollups(ws: Workspace, path: str) -> dict[str, DataFrame]:
    """The four rollups over the days the extracts show, from hour states written once.

    The text of the log is parsed and deduplicated once per kind, and only for
    those days, rather than once per extract and window bound over all history.
    """
    index, days = ws.log_index(), max(WINDOW_DAYS.values())
    states = {"SERVER": monitor.host_states, "JVM": monitor.jvm_states}

    def write(kind: str) -> DataFrame:
        hours, target = states[kind](recent_samples(ws, kind, index, days), hourly=True), f"{path}/{kind.lower()}_hours"
        hours.write.mode("overwrite").parquet(target)
        return ws.spark.read.schema(hours.schema).parquet(target)

    hosts, jvms = at_once(ws.spark, write, states)
    return monitor.four_rollups(hosts, jvms, ws.get("registry_info"))


def run_exports(ws: Workspace, out: str, work: str, tasks: tuple[ExportTask, ...] = TASKS) -> DataFrame:
    """Write every extract; an empty one is flagged and not written.

    Extracts run at the same time, or one by one if two go to the same file, so that the last one stays.
    """
    if not tasks:
        raise ValueError("no export tasks")
    rollups = write_rollups(ws, work)

    def deliver(task: ExportTask) -> tuple:
        source = rollups[task.dataset] if task.dataset in rollups else ws.get(task.dataset)
        table = export_rows(source, task.kind, task.max_rows)
        total = recent_rows(source, task.kind).count()
        rows = write_csv(table, f"{out}/{task.file_name}", LABELS["monitor"], bounded=task.max_rows is not None) if total else 0
        return (task.dataset, task.file_name, task.kind, rows, not total, total, rows < total)

    apart = len({task.file_name for task in tasks}) == len(tasks)
    done = at_once(ws.spark, deliver, tasks, AT_ONCE if apart else 1)
    return ws.spark.createDataFrame(done, "dataset string, file_name string, kind string, rows_written bigint, "
                                          "is_empty boolean, total_rows bigint, truncated boolean")
