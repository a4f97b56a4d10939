"""Report parameters, their defaults, and binding them to query text."""

from __future__ import annotations

import calendar as cal
import datetime as dt
import json
import re
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

# Fixed value: first month of the history reports when none is given.
HISTORY_START = "2025-09"

# The names under which query text asks for parameters.
NAMES = {
    "targetMonth": "target_month", "rangeStartDate": "range_start_date",
    "rangeEndDate": "range_end_date", "rangeStartTime": "range_start_time",
    "rangeEndTime": "range_end_time", "historyStartMonth": "history_start_month",
    "historyEndMonth": "history_end_month", "previousTargetMonth": "previous_target_month",
    "previousRangeStartTime": "previous_range_start_time",
    "previousRangeEndTime": "previous_range_end_time",
}

PLACEHOLDER = re.compile(r"'?\$\{([a-zA-Z][a-zA-Z0-9]*)\}'?")


def _parsed(value: str, pattern: str, name: str, form: str) -> dt.datetime:
    try:
        found = dt.datetime.strptime(value, pattern)
    except ValueError:
        found = None
    # strptime also takes single digits; the form is fixed width
    if found is None or found.strftime(pattern) != value:
        raise ValueError(f"{name}: {value!r} is not of the form {form}")
    return found


def _month(value: str, name: str) -> dt.date:
    return _parsed(value, "%Y-%m", name, "YYYY-MM").date()


def _date(value: str, name: str) -> dt.date:
    return _parsed(value, "%Y-%m-%d", name, "YYYY-MM-DD").date()


def _time(value: str, name: str) -> dt.datetime:
    return _parsed(value.replace("T", " "), "%Y-%m-%d %H:%M", name, "YYYY-MM-DD HH:mm")


def month_date(month: str) -> dt.date:
    """The first day of ``yyyy-MM``."""
    return _month(month, "month")


def month_text(day: dt.date) -> str:
    return f"{day.year:04d}-{day.month:02d}"


def month_end(day: dt.date) -> dt.date:
    return day.replace(day=cal.monthrange(day.year, day.month)[1])


def month_before(day: dt.date) -> dt.date:
    return (day.replace(day=1) - dt.timedelta(days=1)).replace(day=1)


def months_between(first: str, last: str) -> list[str]:
    """All months from ``first`` to ``last``, both included."""
    day, end, found = month_date(first), month_date(last), []
    while day <= end:
        found.append(month_text(day))
        day = (day + dt.timedelta(days=32)).replace(day=1)
    return found


@dataclass(frozen=True)
class ReportParams:
    """All ten parameters; build with :meth:`resolve` to fill what is missing."""

    target_month: str
    range_start_date: str
    range_end_date: str
    range_start_time: str
    range_end_time: str
    history_start_month: str
    history_end_month: str
    previous_target_month: str
    previous_range_start_time: str
    previous_range_end_time: str

    @classmethod
    def resolve(cls, *, target_month=None, range_start_date=None, range_end_date=None,
                range_start_time=None, range_end_time=None, history_start_month=None,
                history_end_month=None, today: dt.date | None = None,
                history_start_default: str = HISTORY_START) -> ReportParams:
        """Derive missing parameters from the ones given, else from last month."""
        def clean(value):
            return (value or "").strip() or None

        given_target = clean(target_month)
        start_date, end_date = clean(range_start_date), clean(range_end_date)
        start_time, end_time = clean(range_start_time), clean(range_end_time)
        if given_target:
            target = _month(given_target, "targetMonth")
        elif end_date or start_date:
            target = _date(end_date or start_date, "rangeEndDate" if end_date else "rangeStartDate").replace(day=1)
        elif end_time or start_time:
            target = _time(end_time or start_time, "rangeEndTime" if end_time else "rangeStartTime").date().replace(day=1)
        else:
            target = month_before(today or dt.date.today())

        first = _date(start_date, "rangeStartDate") if start_date else target
        last = _date(end_date, "rangeEndDate") if end_date else month_end(target)
        if last < first:
            raise ValueError(f"the date range ends on {last} before it starts on {first}")
        begin = _time(start_time, "rangeStartTime") if start_time else dt.datetime.combine(first, dt.time())
        stop = _time(end_time, "rangeEndTime") if end_time else dt.datetime.combine(last, dt.time(23, 59))
        if stop < begin:
            raise ValueError(f"the time range ends at {stop} before it starts at {begin}")
        history_end = clean(history_end_month)
        to_month = _month(history_end, "historyEndMonth") if history_end else target
        from_month = _month(clean(history_start_month) or history_start_default, "historyStartMonth")
        if to_month < from_month:
            raise ValueError("the history ends before it starts")

        before = month_before(target)
        return cls(
            target_month=month_text(target), range_start_date=first.isoformat(),
            range_end_date=last.isoformat(), range_start_time=f"{begin:%Y-%m-%d %H:%M}",
            range_end_time=f"{stop:%Y-%m-%d %H:%M}", history_start_month=month_text(from_month),
            history_end_month=month_text(to_month), previous_target_month=month_text(before),
            previous_range_start_time=f"{before:%Y-%m-%d} 00:00",
            previous_range_end_time=f"{month_end(before):%Y-%m-%d} 23:59")

    def named(self) -> dict[str, str]:
        """The ten parameters under the names query text uses."""
        return {name: getattr(self, field) for name, field in NAMES.items()}

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=2)


def run_query(spark: SparkSession, text: str, params: ReportParams) -> DataFrame:
    """Run query text with ``${name}`` placeholders (quoted or not) as bound parameters.

    Values never become part of the SQL text; an unknown name is an error.
    """
    known, used = params.named(), {}

    def marker(found: re.Match) -> str:
        name = found.group(1)
        if name not in known:
            raise ValueError(f"the query names {name}, which no parameter has")
        used[name] = known[name]
        return f":{name}"

    return spark.sql(PLACEHOLDER.sub(marker, text), args=used)
