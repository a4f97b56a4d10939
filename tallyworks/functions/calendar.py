"""Date keys, calendar parts and calendar labels.

All text is cut and cast rather than run through date patterns: casts stay in
generated code and do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday labels, Sunday first.
WEEKDAYS = ("日", "一", "二", "三", "四", "五", "六")

# Fixed value: year 0 of the Republic calendar.
REPUBLIC_EPOCH = 1911

ISO_STAMP = r"^\s*\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}\s*$"


def file_date(dt: Column) -> Column:
    """``yyyymmdd`` text to a date; malformed text is an error, as it names a file."""
    return F.make_date(F.substring(dt, 1, 4).cast("int"), F.substring(dt, 5, 2).cast("int"),
                       F.substring(dt, 7, 100).cast("int"))


def key_part(key: Column, start: int) -> Column:
    """Two characters of a date key as an int, NULL when they are not one."""
    return F.substring(key, start, 2).try_cast("int")


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """A date, or NULL when a part is missing or no such day exists."""
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(year, month, day, zero, zero, zero).cast("date")


def latest_not_after(guess: Column, file_dt: Column) -> Column:
    """Move a date that lies after its file's date back by one year."""
    return F.when(guess > file_dt, F.add_months(guess, -12)).otherwise(guess)


def date_from_key(key: Column, file_dt: Column) -> Column:
    """The date behind a year-less ``MMDD`` key seen in a file of ``file_dt``."""
    guess = date_from_parts(F.year(file_dt), key_part(key, 1), key_part(key, 3))
    return latest_not_after(guess, file_dt)


def iso_stamp(text: Column) -> Column:
    """Strict ISO text with a 1 to 6 digit fraction, else NULL."""
    return F.when(text.rlike(ISO_STAMP), F.trim(text).try_cast("timestamp_ntz"))


def loose_stamp(text: Column) -> Column:
    """Timestamp text with at least a full date, else NULL."""
    trimmed = F.trim(text)
    # a bare year or year-month is no timestamp here
    return F.when(F.length(trimmed) >= 8, F.translate(trimmed, "/", "-").try_cast("timestamp_ntz"))


def hour_stamp(day: Column, hour: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour)


def day_text(day: Column) -> Column:
    return day.cast("string")


def month_text(day: Column) -> Column:
    return F.substring(day.cast("string"), 1, 7)


def year_text(day: Column) -> Column:
    return F.substring(day.cast("string"), 1, 4)


def month_day_text(day: Column) -> Column:
    text = day.cast("string")
    return F.concat(F.substring(text, 6, 2), F.substring(text, 9, 2))


def weekday_label(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(label) for label in WEEKDAYS]), F.dayofweek(day))


def iso_week_label(day: Column) -> Column:
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-"),
                    F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def week_start(day: Column) -> Column:
    return F.trunc(day, "week")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(month_end(day))


def hour_of(stamp: Column) -> Column:
    return F.hour(stamp)


def republic_date(day: Column) -> Column:
    """``yyy/MM/dd`` in the Republic calendar."""
    month_and_day = F.substring(F.translate(day.cast("string"), "-", "/"), 5, 6)
    return F.concat((F.year(day) - REPUBLIC_EPOCH).cast("string"), month_and_day)


def hour_range(day: Column, hour: Column) -> Column:
    """``yyy/MM/dd HH:00~HH:59``."""
    hh = F.lpad(hour.cast("string"), 2, "0")
    return F.concat(republic_date(day), F.lit(" "), hh, F.lit(":00~"), hh, F.lit(":59"))
