"""One run of all reports: a folder of CSV tables, the parameters, and a status per report."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import calendar
from tallyworks.operators.pivots import message_table
from tallyworks.plans import monitor, stats
from tallyworks.plans.params import ReportParams, month_date, month_end, run_query
from tallyworks.plans.reports import (
    REPORTS,
    Report,
    month_codes,
    period_codes,
    periods_of,
    range_margin,
    sort_columns,
)
from tallyworks.plans.workspace import Workspace
from tallyworks.session import at_once
from tallyworks.sources.csvout import write_csv
from tallyworks.sources.listing import move, remove
from tallyworks.sources.schemas import LABELS

STATUS = "position int, number string, title string, rows bigint, ok boolean, error string"


class ReportRunFailed(RuntimeError):
    """Raised after the status table is written; ``status`` holds it."""

    def __init__(self, message: str, status: DataFrame):
        super().__init__(message)
        self.status = status


def in_number_order(reports: Sequence[Report]) -> list[Report]:
    """1, 1.1, 1.1.1, 2 ...: numbers compare part by part; reports without one come last."""
    return sorted(reports, key=lambda r: (not r.number, [int(part) for part in r.number.split(".") if part],
                                          r.title))


def report_from_sql(title: str, text: str) -> Report:
    """A report from query text over the datasets, with ``${name}`` parameters. Its
    number is the one its title starts with; rows are delivered as the query orders them."""
    def build(ws: Workspace, params: ReportParams) -> DataFrame:
        ws.register_views(text)
        return run_query(ws.spark, text, params)

    number = re.match(r"(?:\d+(?:\.\d+)*)?", title).group(0)
    return Report(number, title, build, (), pivot="PIVOT" in text.upper())


def dates_needed(p: ReportParams) -> tuple[dt.date, dt.date]:
    """The first and last transaction date any report of these parameters reads."""
    months = [p.target_month, p.previous_target_month, p.history_start_month, p.history_end_month]
    ranges = [range_margin(p.range_start_time, p.range_end_time),
              range_margin(p.previous_range_start_time, p.previous_range_end_time)]
    starts = [month_date(m) for m in months] + [first for first, _ in ranges]
    ends = [month_end(month_date(m)) for m in months] + [last for _, last in ranges]
    return min(starts), max(ends)


def write_silver(ws: Workspace, p: ReportParams, path: str) -> Workspace:
    """A workspace for one run: clean hourly rows by month and host days, written once.

    Only dates the run reads are cleaned, so a run does not re-read the whole
    lake. All volume reports then share one dedup, those that look at whole
    days share one day frame, written from the hourly rows, and those that show shares read
    codes and period totals folded together. The tables serve the reports of these parameters.
    """
    first, last = dates_needed(p)
    frames = dict(ws.frames)
    if ws.has("rt_pr_hh24") or ws.has("rt_pr_hh24_clean"):
        frames["rt_pr_hh24_clean"] = ws.hourly(first, last)
    if ws.has("mon_log"):
        start, end = (dt.date.fromisoformat(day) for day in (p.range_start_date, p.range_end_date))
        log = ws.log_of("SERVER", ws.log_index(), start, end)
        frames["monitor_daily"] = monitor.monitor_daily(log, ws.get("registry_info"))
    run = Workspace(ws.spark, frames, prefixes=ws.prefixes, excluded_codes=ws.excluded_codes)

    def volumes() -> None:
        hourly = run.write("rt_pr_hh24_clean", path, ["tx_yyyymm"])
        run.frames["day_frame"] = stats.day_frame(hourly).withColumn(
            "tx_yyyymm", calendar.month_text(F.col("tx_dt")))
        run.write("day_frame", path, ["tx_yyyymm"])
        run.frames |= {
            "month_codes": month_codes(run, p.previous_target_month, p.target_month, stats.code_totals),
            "period_codes": period_codes(run, periods_of(p), stats.code_totals)}
        at_once(ws.spark, lambda name: run.write(name, path), ["month_codes", "period_codes"])

    def hosts() -> None:
        run.write("monitor_daily", path)

    steps = {"rt_pr_hh24_clean": volumes, "monitor_daily": hosts}
    at_once(ws.spark, lambda step: step(), [step for name, step in steps.items() if run.has(name)])
    return run


def write_report(ws: Workspace, params: ReportParams, report: Report, path: str) -> int:
    """Write one report; a pivot without rows delivers the message table instead."""
    table = report.build(ws, params)
    rows = write_csv(table, path, LABELS.get(report.labels), order=sort_columns(report, table),
                     bounded=report.bounded)
    if rows == 0 and report.pivot:
        rows = write_csv(message_table(table, report.title), path, bounded=True)
    return rows


def run_reports(ws: Workspace, params: ReportParams, out: str, reports: Sequence[Report] = REPORTS, *,
                work: str | None = None, continue_on_error: bool = False) -> DataFrame:
    """Write each report below ``out``. Stops at the first failure unless told to go
    on; a run with any failure is reported as failed either way.

    Reports are independent of each other and run at the same time, each into a folder aside.
    They are put in place in the order of their numbers, so that a run that stops at a failure leaves
    the reports before it, as if they had run one by one: later ones that were finished already are dropped.
    With ``work``, the shared clean tables are written there first.
    """
    spark, failed = ws.spark, []
    if work is not None:
        ws = write_silver(ws, params, work)
    spark.createDataFrame([(params.to_json(),)], "value string").coalesce(1).write.mode(
        "overwrite").text(f"{out}/parameters")
    aside = f"{out}/_aside-{uuid.uuid4().hex}"

    def run(job: tuple[int, Report]) -> tuple | None:
        position, report = job
        if not continue_on_error and any(other < position for other in failed):
            return None
        try:
            rows = write_report(ws, params, report, f"{aside}/{position}")
            return (position, report.number, report.title, rows, True, None)
        except (PySparkException, Py4JJavaError, ValueError, KeyError) as error:
            failed.append(position)
            return (position, report.number, report.title, 0, False, str(error))

    try:
        done = at_once(spark, run, list(enumerate(in_number_order(reports), 1)))
        last = len(done) if continue_on_error else min(failed, default=len(done))
        status = done[:last]
        for position, _, title, _, ok, _ in status:
            if ok:
                move(spark, f"{aside}/{position}", f"{out}/{title}")
    finally:
        remove(spark, aside)
    table = spark.createDataFrame(status, STATUS)
    table.coalesce(1).write.mode("overwrite").json(f"{out}/status")
    if failed:
        raise ReportRunFailed("report run finished with failures" if continue_on_error
                              else "report run stopped at the first failure", table)
    return table
