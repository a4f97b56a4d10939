"""The twenty reports.

Titles, parameters and source datasets are documented; of the definitions only
the weighted mean, the statistics page and the use of it by the month-over-month
report are. The rest follows the title.

Volume reports start from the day frame of the clean hourly rows, or from the hours
where they cut inside a day. A report asks for its own dates only, so written
months (or landed days) outside are not read; aggregates it does not use are pruned.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import calendar
from tallyworks.functions.numbers import (
    mean_of_hundredths,
    percentage,
    whole_number,
)
from tallyworks.operators.peaks import earlier, peak
from tallyworks.operators.pivots import conditional, spread
from tallyworks.plans import clean, stats
from tallyworks.plans.params import ReportParams, month_date, month_end, months_between
from tallyworks.plans.workspace import Workspace

HOURS = list(range(24))
Fold = Callable[[DataFrame, list[str]], DataFrame]


def _days_of_months(ws: Workspace, first: str, last: str) -> DataFrame:
    return ws.days(month_date(first), month_end(month_date(last)))


def _target_days(ws: Workspace, p: ReportParams) -> DataFrame:
    return _days_of_months(ws, p.target_month, p.target_month)


def _history_days(ws: Workspace, p: ReportParams) -> DataFrame:
    return _days_of_months(ws, p.history_start_month, p.history_end_month)


def volume_of_month(ws: Workspace, p: ReportParams) -> DataFrame:
    return _target_days(ws, p).groupBy("pr_id").agg(
        F.sum("day_cnt").alias("total_cnt"), F.count("tx_dt").alias("active_days"))


def volume_per_day(ws: Workspace, p: ReportParams) -> DataFrame:
    return _target_days(ws, p).select(calendar.day_text(F.col("tx_dt")).alias("tx_date"), "pr_id",
                                      F.col("day_cnt").alias("total_cnt"))


# Fixed value: the title that the message of an empty pivot names.
VOLUME_PER_DAY_PIVOT = "2.1.交易量統計-當月每日-Pivot"


def volume_per_day_pivot(ws: Workspace, p: ReportParams, codes: list[str] | None = None) -> DataFrame:
    return spread(volume_per_day(ws, p), ["tx_date"], "pr_id", [F.sum("total_cnt")],
                  VOLUME_PER_DAY_PIVOT, codes)


def _peaks(days: DataFrame, keys: list[str]) -> DataFrame:
    """The busiest day per key and the busiest hour inside that day."""
    day, cnt = F.col("tx_dt"), F.col("day_cnt")
    row = F.struct(day.alias("day"), cnt.alias("cnt"), F.col("best").alias("best"))
    top = days.groupBy(*keys).agg(peak(row, cnt, earlier(day)).alias("top"))
    return top.select(
        *keys, calendar.day_text(F.col("top.day")).alias("peak_day"),
        F.col("top.cnt").alias("peak_day_cnt"), F.col("top.best.hour").alias("peak_hour"),
        F.col("top.best.cnt").alias("peak_hour_cnt"))


def peak_day_and_hour(ws: Workspace, p: ReportParams) -> DataFrame:
    return _peaks(_target_days(ws, p), ["pr_id"])


def peak_day_hours_pivot(ws: Workspace, p: ReportParams) -> DataFrame:
    """The 24 hours of each code's busiest day as columns ``h00`` to ``h23``."""
    names = [f"h{h:02d}" for h in HOURS]
    # the column values are known, so plain conditional sums pivot in one hash aggregate
    hours = [F.sum(conditional(F.col("tx_cnt"), "tx_hour", h)).alias(n) for h, n in zip(HOURS, names)]
    target = month_date(p.target_month)
    days = ws.hourly(target, month_end(target)).groupBy("tx_dt", "pr_id").agg(
        F.sum("tx_cnt").alias("total_cnt"), *hours)
    row = F.struct(F.col("tx_dt"), F.col("total_cnt"), *names)
    top = days.groupBy("pr_id").agg(peak(row, F.col("total_cnt"), earlier(F.col("tx_dt"))).alias("top"))
    return top.select("pr_id", calendar.day_text(F.col("top.tx_dt")).alias("peak_day"),
                      F.col("top.total_cnt").alias("peak_day_cnt"),
                      *[F.col(f"top.{n}").alias(n) for n in names])


def month_codes(ws: Workspace, first: str, last: str, fold: Fold = stats.code_frame) -> DataFrame:
    """Codes per month: a run's written table, which has the totals of months too, or folded from the days."""
    if ws.has("month_codes"):
        return ws.get("month_codes").filter(F.col("ym").between(first, last))
    return fold(stats.monthly(_days_of_months(ws, first, last)), ["ym"])


def all_categories(ws: Workspace, p: ReportParams) -> DataFrame:
    """Volume, weighted mean ms and share of the month per registered code."""
    frame = month_codes(ws, p.target_month, p.target_month)
    rows = stats.with_codes(stats.with_period_total(frame, ["ym"]), ws.get("pr_info"))
    return rows.select("ym", "pr_id", "category", "name", "total_cnt",
                       whole_number(F.col("mean_ms"), "int").alias("avg_ms"),
                       percentage(F.col("total_cnt"), F.col("all_cnt")).alias("share_pct"))


def _top(ws: Workspace, p: ReportParams, category: str, rows: int = 6) -> DataFrame:
    found = all_categories(ws, p).filter(F.col("category") == category)
    return found.orderBy(F.desc("total_cnt"), "pr_id").limit(rows)


def top_updates(ws: Workspace, p: ReportParams) -> DataFrame:
    return _top(ws, p, "update")


def top_queries(ws: Workspace, p: ReportParams) -> DataFrame:
    return _top(ws, p, "query")


def _change(now, before) -> list:
    diff = F.coalesce(now, F.lit(0)) - F.coalesce(before, F.lit(0))
    return [diff.alias("diff_cnt"), percentage(diff, before).alias("diff_pct")]


def month_over_month(ws: Workspace, p: ReportParams) -> DataFrame:
    """Volume of the month and the month before per code, in one pass over both."""
    frame = month_codes(ws, p.previous_target_month, p.target_month)
    page = stats.details(frame, ws.get("pr_info"), ["ym"])
    both = page.groupBy("pr_id").agg(
        F.max(F.when(F.col("ym") == p.previous_target_month, F.col("total_cnt"))).alias("prev_cnt"),
        F.max(F.when(F.col("ym") == p.target_month, F.col("total_cnt"))).alias("cur_cnt"))
    return both.select("pr_id", "prev_cnt", "cur_cnt", *_change(F.col("cur_cnt"), F.col("prev_cnt")))


def _host_days(ws: Workspace, p: ReportParams) -> DataFrame:
    return clean.within(ws.get("monitor_daily"), p.range_start_date, p.range_end_date, "log_date")


def host_summary(ws: Workspace, p: ReportParams) -> DataFrame:
    """Greatest and mean daily CPU and memory per application and host in the range."""
    def mean_of_days(column: str):
        value = F.round(F.col(column) * 100).cast("bigint")
        return mean_of_hundredths(F.sum(value), F.count(column))

    return _host_days(ws, p).groupBy("application", "target_ip").agg(
        F.count("log_date").alias("days"), F.max("max_cpu_rate").alias("max_cpu_rate"),
        mean_of_days("avg_cpu_rate").alias("avg_cpu_rate"),
        F.max("max_mem_rate").alias("max_mem_rate"),
        mean_of_days("avg_mem_rate").alias("avg_mem_rate"))


def host_day_list(ws: Workspace, p: ReportParams) -> DataFrame:
    return _host_days(ws, p).select("application", "target_ip", "log_date", "max_cpu_rate",
                                    "avg_cpu_rate", "max_mem_rate", "avg_mem_rate")


def history_totals(ws: Workspace, p: ReportParams) -> DataFrame:
    return stats.monthly(_history_days(ws, p)).groupBy("ym", "pr_id").agg(
        F.sum("day_cnt").alias("total_cnt"))


def _history_months(p: ReportParams) -> list[str]:
    return months_between(p.history_start_month, p.history_end_month)


def history_totals_pivot(ws: Workspace, p: ReportParams) -> DataFrame:
    return spread(history_totals(ws, p), ["pr_id"], "ym", [F.sum("total_cnt")], "history totals",
                  _history_months(p))


def history_peak_days(ws: Workspace, p: ReportParams) -> DataFrame:
    """The busiest day per month and code."""
    return history_peaks(ws, p).select("ym", "pr_id", "peak_day", "peak_day_cnt")


def _history_pivot(rows: DataFrame, p: ReportParams, report: str) -> DataFrame:
    """One group of columns per month, from rows that are unique per month and code."""
    measures = [F.max(c).alias(c) for c in rows.columns if c not in ("ym", "pr_id")]
    return spread(rows, ["pr_id"], "ym", measures, report, _history_months(p))


def history_peak_days_pivot(ws: Workspace, p: ReportParams) -> DataFrame:
    return _history_pivot(history_peak_days(ws, p), p, "history peak days")


def history_peaks(ws: Workspace, p: ReportParams) -> DataFrame:
    return _peaks(stats.monthly(_history_days(ws, p)), ["ym", "pr_id"])


def history_peaks_pivot(ws: Workspace, p: ReportParams) -> DataFrame:
    return _history_pivot(history_peaks(ws, p), p, "history peaks")


def range_margin(start: str, end: str) -> tuple[dt.date, dt.date]:
    """The dates that can hold hours of a time range. A two-character hour moves the
    time by up to four days from its date."""
    first, last = (dt.date.fromisoformat(value[:10]) for value in (start, end))
    return first - dt.timedelta(days=5), last + dt.timedelta(days=1)


def periods_of(p: ReportParams) -> dict[str, tuple[str, str]]:
    return {"cur": (p.range_start_time, p.range_end_time),
            "prev": (p.previous_range_start_time, p.previous_range_end_time)}


def period_codes(ws: Workspace, periods: dict[str, tuple[str, str]], fold: Fold = stats.code_frame) -> DataFrame:
    """Codes per named time range, from a run's written table or from the hours. An hour inside two ranges counts in both."""
    if ws.has("period_codes"):
        return ws.get("period_codes").filter(F.col("period").isin(*periods))
    first, last = range_margin(min(start for start, _ in periods.values()),
                               max(end for _, end in periods.values()))
    hours = ws.hourly(first, last)
    stamp = F.col("tx_hour_ts")

    def inside(bounds):
        start, end = (F.lit(f"{b}:00").cast("timestamp_ntz") for b in bounds)
        return stamp.between(start, end)

    wanted = reduce(or_, [inside(bounds) for bounds in periods.values()])
    tags = [F.when(inside(bounds), F.lit(name)) for name, bounds in periods.items()]
    tagged = hours.filter(wanted).withColumn("period", F.explode(F.array_compact(F.array(*tags))))
    return fold(stats.day_frame(tagged, ["period"]), ["period"])


def _period_details(ws: Workspace, periods: dict[str, tuple[str, str]]) -> DataFrame:
    """The statistics page per named time range."""
    return stats.details(period_codes(ws, periods), ws.get("pr_info"), ["period"])


def range_details(ws: Workspace, p: ReportParams) -> DataFrame:
    page = _period_details(ws, {"cur": periods_of(p)["cur"]})
    return page.drop("period")


def _two_periods(ws: Workspace, p: ReportParams) -> DataFrame:
    return _period_details(ws, periods_of(p))


def _side(name: str, column: str):
    return F.max(F.when(F.col("period") == name, F.col(column))).alias(f"{name}_{column}")


def range_details_compared(ws: Workspace, p: ReportParams) -> DataFrame:
    """The statistics page of two ranges side by side; a code may miss in one."""
    columns = ["total_cnt", "peak_day", "peak_day_cnt", "peak_hour_range", "peak_hour_cnt", "avg_ms",
               "peak_ms_label", "share", "active_days"]
    return _two_periods(ws, p).groupBy("pr_id", "category", "name").agg(
        *[_side(name, column) for name in ("cur", "prev") for column in columns])


def range_volume_compared(ws: Workspace, p: ReportParams) -> DataFrame:
    both = _two_periods(ws, p).groupBy("pr_id", "category", "name").agg(
        *[_side(name, column) for name in ("cur", "prev") for column in ("total_cnt", "avg_ms")])
    ms_diff = F.coalesce("cur_avg_ms", F.lit(0)) - F.coalesce("prev_avg_ms", F.lit(0))
    return both.select("*", *_change(F.col("cur_total_cnt"), F.col("prev_total_cnt")),
                       ms_diff.alias("diff_ms"))


@dataclass(frozen=True)
class Report:
    """``bounded`` marks tables that are small by definition: a top-n, or a row per day
    of a month. ``pivot`` marks tables that deliver a message when they are empty.
    ``labels`` names the set of column labels of the delivered table."""

    number: str
    title: str
    build: Callable[[Workspace, ReportParams], DataFrame]
    order: tuple[str, ...]
    bounded: bool = False
    pivot: bool = False
    labels: str | None = None


# Report numbers and titles.
REPORTS = (
    Report("1", "1.交易量統計-當月", volume_of_month, ("pr_id",)),
    Report("1.1", "1.1.CPU-MEM監控", host_summary, ("application", "target_ip")),
    Report("1.1.1", "1.1.1. CPU-MEM監控-每日列表", host_day_list, ("application", "target_ip", "log_date")),
    Report("2", "2.交易量統計-當月每日", volume_per_day, ("tx_date", "pr_id")),
    Report("2.1", VOLUME_PER_DAY_PIVOT, volume_per_day_pivot, ("tx_date",), True, True),
    Report("3", "3.交易量統計-峰日峰時", peak_day_and_hour, ("pr_id",)),
    Report("3.1", "3.1.交易量統計-峰日峰時-Pivot", peak_day_hours_pivot, ("pr_id",), pivot=True),
    Report("4", "4.交易量統計-歷史月總量", history_totals, ("ym", "pr_id")),
    Report("4.1", "4.1.交易量統計-歷史月總量-Pivot", history_totals_pivot, ("pr_id",), pivot=True),
    Report("5", "5.交易量統計-歷史峰日", history_peak_days, ("ym", "pr_id")),
    Report("5.1", "5.1.交易量統計-歷史峰日-Pivot", history_peak_days_pivot, ("pr_id",), pivot=True),
    Report("6", "6.交易量統計-歷史峰日峰時", history_peaks, ("ym", "pr_id")),
    Report("6.1", "6.1.交易量統計-歷史峰日峰時-Pivot", history_peaks_pivot, ("pr_id",), pivot=True),
    Report("7", "7.交易量統計-所有交易類別", all_categories, ("category", "-total_cnt", "pr_id")),
    Report("7.1", "7.1.交易量統計-TOP6交易類", top_updates, ("-total_cnt", "pr_id"), True),
    Report("7.2", "7.2.交易量統計-TOP6查詢類", top_queries, ("-total_cnt", "pr_id"), True),
    Report("8", "8.交易量統計-所有交易類別-詳細資訊", range_details, ("-category", "-total_cnt", "pr_id"),
           labels="monthly_transaction_stats"),
    Report("8.1", "8.1.交易量統計-月度比較-所有交易類別-詳細資訊", range_details_compared, ("pr_id",)),
    Report("8.2", "8.2.交易量統計-月度比較-所有交易類別-簡易比較", range_volume_compared, ("pr_id",)),
    Report("8.3", "8.3.交易量統計-MOM交易量比較", month_over_month, ("pr_id",)),
)


def sort_columns(report: Report, table: DataFrame) -> list:
    """Order of the delivered rows; a leading minus sorts descending, NULLs go last."""
    columns = []
    for name in report.order:
        column = F.col(name.removeprefix("-"))
        if name.removeprefix("-") in table.columns:
            columns.append(column.desc_nulls_last() if name.startswith("-") else column.asc_nulls_last())
    return columns
