"""Day, ISO-week and month rollups of the code counts.

The day frame has one row per date and code, so distinct days of a code are a
plain count there and only the all-codes rollup needs a distinct aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import calendar
from tallyworks.functions.numbers import percentage, ratio, whole_number
from tallyworks.operators.peaks import earlier, peak_present

COUNTS = ["total_cnt", "ok_cnt", "fail_cnt", "timeout_cnt"]


def day_counts(clean: DataFrame) -> DataFrame:
    """Counts per date and code. Grouping on the dedup keys needs no second shuffle."""
    return clean.groupBy("tx_dt", "pr_id").agg(*[F.sum(c).alias(c) for c in COUNTS])


def rt_cnt_daily(clean: DataFrame) -> DataFrame:
    return _daily(day_counts(clean)).drop("tx_dt")


def _daily(days: DataFrame) -> DataFrame:
    day = F.col("tx_dt")
    return days.select(
        "tx_dt", calendar.year_text(day).alias("year"), calendar.month_text(day).alias("ym"),
        calendar.iso_week_label(day).alias("iso_yw"), calendar.day_text(day).alias("tx_date"),
        calendar.weekday_label(day).alias("weekday"), "pr_id", *COUNTS,
        percentage(F.col("ok_cnt"), F.col("total_cnt")).alias("ok_rate"))


def mean_times(times: DataFrame) -> DataFrame:
    """Mean seconds and milliseconds per date and code."""
    return times.groupBy("tx_dt", "pr_id").agg(F.avg("avg_tm_sec").alias("avg_tm_sec"),
                                               F.avg("avg_tm_ms").alias("avg_tm_ms"))


def rt_cnt_daily_with_tmspt(clean: DataFrame, times: DataFrame) -> DataFrame:
    """Both sides are already partitioned by date and code, so the join adds no shuffle."""
    joined = _daily(day_counts(clean)).join(mean_times(times), ["tx_dt", "pr_id"], "left")
    return joined.select("year", "ym", "iso_yw", "tx_date", "weekday", "pr_id", *COUNTS, "ok_rate",
                         "avg_tm_sec", "avg_tm_ms")


def _rollup(data_days: Column) -> list[Column]:
    day, total = F.col("tx_dt"), F.col("total_cnt")
    return [F.min(day).alias("data_start"), F.max(day).alias("data_end"), data_days.alias("data_days"),
            *[F.sum(c).alias(f"{c}_sum") for c in COUNTS], F.max(total).alias("peak_day_cnt"),
            peak_present(day, total, total, earlier(day)).alias("peak_day")]


def _finish(frame: DataFrame, keys: Sequence, mean_name: str, mean_days: Column) -> DataFrame:
    total = F.col("total_cnt_sum")
    return frame.select(
        *keys, "data_days", total.alias("total_cnt"),
        whole_number(ratio(total, F.col("data_days"))).alias("avg_per_data_day"),
        whole_number(ratio(total, mean_days)).alias(mean_name), "peak_day_cnt", "peak_day",
        *[F.col(f"{c}_sum").alias(c) for c in COUNTS[1:]],
        percentage(F.col("ok_cnt_sum"), total).alias("ok_rate"))


def rt_cnt_weekly(clean: DataFrame) -> DataFrame:
    """ISO week rollup. A week across New Year keeps one row per calendar year."""
    days = day_counts(clean).withColumns({"year": calendar.year_text(F.col("tx_dt")),
                                          "week_start": calendar.week_start(F.col("tx_dt"))})
    weeks = days.groupBy("year", "week_start", "pr_id").agg(*_rollup(F.count("tx_dt")))
    start = F.col("week_start")
    return _finish(weeks, ["year", calendar.iso_week_label(start).alias("iso_yw"), "week_start",
                           F.date_add(start, 6).alias("week_end"), "data_start", "data_end", "pr_id"],
                   "avg_per_7_days", F.lit(7))


def _month_keys() -> list:
    start = F.col("month_start")
    return [calendar.year_text(start).alias("year"), calendar.month_text(start).alias("ym"), "month_start",
            F.last_day(start).alias("month_end"), "data_start", "data_end"]


def rt_cnt_monthly(clean: DataFrame) -> DataFrame:
    days = day_counts(clean).withColumn("month_start", calendar.month_start(F.col("tx_dt")))
    months = days.groupBy("month_start", "pr_id").agg(*_rollup(F.count("tx_dt")))
    return _finish(months, [*_month_keys(), "pr_id"], "avg_per_month_day",
                   calendar.days_in_month(F.col("month_start")))


def without_codes(clean: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Rows of other codes; rows without a code drop as well."""
    return clean.filter(~F.col("pr_id").isin(*excluded))


def rt_cnt_monthly_without(clean: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Month rollup over all codes but the excluded; rows without a code drop as well.

    The peak is the largest single row of one code and day, not the largest day total.
    """
    days = day_counts(without_codes(clean, excluded))
    days = days.withColumn("month_start", calendar.month_start(F.col("tx_dt")))
    months = days.groupBy("month_start").agg(*_rollup(F.count_distinct("tx_dt")))
    return _finish(months, _month_keys(), "avg_per_month_day",
                   calendar.days_in_month(F.col("month_start")))
