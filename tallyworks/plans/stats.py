"""Volume, weighted time, peaks and share per code and period.

Everything comes from one pass over the hourly rows: they are folded to a day
frame (one row per date and code, carrying the day's best hour), and the day
frame to one row per period and code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyworks.functions import calendar
from tallyworks.functions.numbers import ratio, share_label, whole_number
from tallyworks.functions.text import lines
from tallyworks.operators.peaks import earlier, peak
from tallyworks.sources.schemas import UNNAMED


def day_frame(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per date and code: volume, volume-weighted mean ms and the busiest hour."""
    hour, cnt = F.col("tx_hour"), F.col("tx_cnt")
    days = hourly.groupBy(*keys, "tx_dt", "pr_id").agg(
        F.sum(cnt).alias("day_cnt"), F.sum(F.col("avg_tm_ms") * cnt).alias("_weighted"),
        peak(F.struct(hour.alias("hour"), cnt.alias("cnt")), cnt, -hour).alias("best"))
    return days.withColumn("day_ms", ratio(F.col("_weighted"), F.col("day_cnt"))).drop("_weighted")


def monthly(days: DataFrame) -> DataFrame:
    return days.withColumn("ym", calendar.month_text(F.col("tx_dt")))


def _code_measures() -> list[Column]:
    day, cnt, ms, best = F.col("tx_dt"), F.col("day_cnt"), F.col("day_ms"), F.col("best")
    return [
        F.sum(cnt).alias("total_cnt"), F.sum(ms * cnt).alias("_weighted"),
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(day).alias("active_days"),
        peak(F.struct(day.alias("day"), cnt.alias("cnt"), ms.alias("ms")), ms, earlier(day)).alias("slow"),
        peak(F.struct(day.alias("day"), best["hour"].alias("hour"), best["cnt"].alias("cnt")),
             best["cnt"], earlier(day), -best["hour"]).alias("busy")]


def _with_mean(frame: DataFrame) -> DataFrame:
    return frame.withColumn("mean_ms", ratio(F.col("_weighted"), F.col("total_cnt"))).drop("_weighted")


def code_frame(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per period and code: totals, weighted mean of day means, peak day, peak hour.

    The peak day is the slowest day (by weighted mean ms), the peak hour the
    busiest hour; ties go to the earliest.
    """
    return _with_mean(days.groupBy(*keys, "pr_id").agg(*_code_measures()))


def code_totals(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The code frame and, marked by ``is_total``, a row per period over all codes, in one pass of grouping sets.

    Meant to be written: :func:`with_period_total` then joins the two kinds of rows from the written table.
    A row whose code is NULL is a code's row and no total.
    """
    grouped = days.groupingSets([[*keys, "pr_id"], [*keys]], *keys, "pr_id")
    return _with_mean(grouped.agg((F.grouping("pr_id") == 1).alias("is_total"), *_code_measures()))


def with_period_total(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the volume of all codes, registered or not.

    Rows of a written :func:`code_totals` are joined with their period's total. For a code frame that is not written, a window runs over
    aggregated rows, one per code and period: joining a second aggregate would read and dedup the hourly rows twice.
    """
    if "is_total" in frame.columns:
        totals = frame.filter("is_total").select(*keys, F.col("total_cnt").alias("all_cnt"))
        return frame.filter(~F.col("is_total")).drop("is_total").join(totals, list(keys))
    return frame.withColumn("all_cnt", F.sum("total_cnt").over(W.partitionBy(*keys)))


def code_copies(codes: DataFrame) -> DataFrame:
    """Dimension rows per code with the multiplicity of their category.

    A code listed twice multiplies its rows and totals, as an inner join to the
    dimension before the aggregation would; the factor is applied afterwards so
    the join only meets aggregated rows.
    """
    copies = codes.groupBy("pr_id", "category").agg(F.count(F.lit(1)).alias("copies"))
    return copies.join(codes.select("pr_id", "name"), "pr_id")


def with_codes(frame: DataFrame, codes: DataFrame) -> DataFrame:
    """Attach category and name; codes that are not registered drop."""
    return frame.join(code_copies(codes), "pr_id").withColumns({
        "total_cnt": F.col("total_cnt") * F.col("copies"),
        "active_days": F.col("active_days") * F.col("copies")}).drop("copies")


def _int_ms(value: Column) -> Column:
    return whole_number(value, "int")


def details(frame: DataFrame, codes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The delivered statistics page for the given period keys."""
    rows = with_codes(with_period_total(frame, keys), codes)
    slow, busy = F.col("slow"), F.col("busy")
    return rows.select(
        *keys, "pr_id", "category", F.coalesce("name", F.lit(UNNAMED)).alias("name"), "total_cnt",
        calendar.republic_date(slow["day"]).alias("peak_day"), slow["cnt"].alias("peak_day_cnt"),
        calendar.hour_range(busy["day"], busy["hour"]).alias("peak_hour_range"),
        busy["cnt"].alias("peak_hour_cnt"), _int_ms(F.col("mean_ms")).alias("avg_ms"),
        lines(calendar.republic_date(slow["day"]), _int_ms(slow["ms"])).alias("peak_ms_label"),
        share_label(F.col("total_cnt"), F.col("all_cnt")).alias("share"),
        calendar.republic_date(F.col("first_day")).alias("first_date"),
        calendar.republic_date(F.col("last_day")).alias("last_date"), "active_days")


def month_page(days: DataFrame, codes: DataFrame) -> DataFrame:
    """The statistics page per month from a day frame."""
    return details(code_frame(monthly(days), ["ym"]), codes, ["ym"])


def monthly_transaction_stats(hourly: DataFrame, codes: DataFrame) -> DataFrame:
    """One row per month and registered code. Undated rows cannot reach a month and
    are dropped before the dedup shuffle."""
    return month_page(day_frame(hourly.filter(F.col("tx_dt").isNotNull())), codes)
